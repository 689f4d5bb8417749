"""Training-data operators on Spark: ten operators, their queries and nothing else.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when it is there.
"""
