import shutil
from collections import defaultdict

import corpus_pipeline as pipeline


def test_one_of_equal_texts_comes_out(spark, small, tmp_path):
    """Of each group of equal texts one doc_id at most comes out of the whole pipeline, and no text that line dedup has emptied."""
    given = spark.read.parquet(f"{small}/documents.parquet")
    again = given.filter("doc_id % 2 = 0").withColumn("doc_id", (given.doc_id + 1_000_000).cast(given.schema["doc_id"].dataType))
    given.unionByName(again).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{small}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    out = pipeline.run(spark, str(tmp_path)).collect()
    groups = defaultdict(list)
    texts = {r.doc_id: r.text for r in given.unionByName(again).collect()}
    for r in out:
        groups[texts[r.doc_id]].append(r.doc_id)
    assert len(out) > 20 and [ids for t, ids in groups.items() if t and len(ids) > 1] == []
    assert [r.doc_id for r in out if r["size"] == 0 and (texts[r.doc_id] or "").split()] == []
    # What comes out for a text is its first document.
    assert all(r.doc_id == min(i for i, t in texts.items() if t == texts[r.doc_id]) for r in out)
