"""Shingles of documents and of benchmark windows hash alike, from word hashes, without an array of
words per place."""

from pyspark.sql import functions as F

from tripmart.llm.decontamination import _tokens, benchmark_windows, shingle_hashes, word_hashes, words_of


def test_document_shingles_meet_window_tokens(spark):
    text = "Alpha beta, GAMMA delta É epsilon zeta eta theta iota kappa lambda mu nu xi"
    docs = spark.createDataFrame([(1, text), (2, "alpha beta"), (3, None)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, text), (2, "alpha beta")], "item_id int, text string")
    tokens = _tokens(benchmark_windows(bench, "item_id", "text", 13, 5), 5)
    wanted = {(r.n, r.token) for r in tokens.collect()}
    hw = docs.select("doc_id", word_hashes(words_of(F.col("text"))).alias("hw"))
    for n in (2, 5):
        seen = {(n, h) for r in hw.select(shingle_hashes(F.col("hw"), n).alias("h")).collect() for h in r.h}
        assert {t for t in wanted if t[0] == n} <= seen
    # Word hashes are made once per document, not again for every place, and no place slices words.
    plan = hw.select(shingle_hashes(F.col("hw"), 5).alias("h"))._jdf.queryExecution().optimizedPlan().toString()
    assert "get(transform(" not in plan and "xxhash64(slice(" not in plan
