"""Parts of the text index grow in number with a batch, not in size."""

from __future__ import annotations

from gavel.plans import textindex


def test_parts_by_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "SLOT_DOCUMENTS", 20, raising=False)
    texts = spark.createDataFrame([(i, f"the word{i % 7} again the") for i in range(200)], "id long, t string")
    index = textindex.TextIndex(spark, str(tmp_path), buckets=1).add(texts, "id", "t", "a")
    parts = [len(list(d.glob("*.parquet"))) for d in (tmp_path / "postings").glob("bucket=*/batch=a")]
    assert sum(parts) > textindex.SLOTS
    found = index.phrases(spark.createDataFrame([(1, "word3 again")], "q int, w string"), "q", "w")
    assert sorted(r["doc"] for r in found.collect()) == list(range(3, 200, 7))
