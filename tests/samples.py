"""Two small uploads in the shape the manual test plan uses, with rows of our own."""

SALES = """店员,片区,成交额,成交日
何晴,东区,4100,2023-05-02
罗盛,西区,9300,2023-06-11
高楠,东区,2700,2023-05-19
林珂,南区,6600,2023-07-08
许沐,西区,3800,2023-08-21
邓岚,南区,7200,2023-06-30
曹毅,东区,5900,2023-09-14
彭越,西区,1500,2023-07-27
"""

SALARY = """店员名,片区,月薪
何晴,东区,5200
罗盛,西区,6100
高楠,东区,4800
林珂,南区,7000
许沐,西区,5600
邓岚,南区,6400
曹毅,东区,5100
彭越,西区,4300
"""


def write(folder: str, name: str, text: str) -> str:
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path
