"""wordlens: word-frequency analytics over URL streams and crawled pages, on Spark.

Layout
------
functions/  Column -> Column expressions (tokenizer, stop words, page text, hashes)
sources/    table, URL-log, file-stream and Kafka sources
operators/  DataFrame -> DataFrame operators (URL dedup, counts, Bloom, count-min)
sinks/      named tables with versions; tables of growing totals
streaming/  Structured Streaming jobs, keyed state, progress reports
plans/      the query catalogue used by __spark_entry__ and bench.py
"""

from wordlens.params import TermConfig  # noqa: F401
from wordlens.session import build_session, scratch_root  # noqa: F401
