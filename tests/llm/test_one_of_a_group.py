import corpus_pipeline as pipeline

TEXT = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"v{i}" for i in range(60))
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_repeated_and_null_ids(spark, small):
    """One row of a group comes out, also where rows or ids repeat or all ids are null; unlike texts of one id all stay."""
    rows = [
        *[(1, TEXT, "en", f"s{i}", 1) for i in range(3)], (1, TEXT + " more", "en", "a", 1), (2, TEXT, "en", "a", 1), (1, "unlike in all", "en", "a", 1),
        *[(None, OTHER, None, "b", None)] * 3, (None, OTHER + " more", "en", "b", 1), (None, "a third text", "en", "b", 1),
        (8, "", "en", "c", 0), (8, "", "en", "c", 0), (9, None, None, None, None), (None, " ", "en", "c", 1),
    ]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = pipeline.keep_one_of_a_group(spark, docs, small)
    assert got.columns == docs.columns
    found = [(r.doc_id, (r.text or "")[:6]) for r in got.collect()]
    want = [(1, TEXT[:6]), (1, "unlike"), (None, OTHER[:6]), (None, "a thir"), (8, ""), (8, ""), (9, ""), (None, " ")]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sorted(map(str, got.collect())) == sorted(map(str, pipeline.keep_one_of_a_group(spark, docs.repartition(2), small).collect()))
