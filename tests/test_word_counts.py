"""content_word_counts against its SQL where upper case and rounding are odd."""

from __future__ import annotations

import oracle
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry

#: Lengths by which a share can end in a 5 at its seventh place.
SHARES = [(n, k) for n in (64, 128, 640, 3200, 16000, 32000) for k in range(1, n, max(1, n // 400))]


def test_content_word_counts_on_odd_texts(spark, tmp_path):
    texts = [None, "", " ", "12 ab", "the ﬁnes oﬃce", "preﬁx ŉow ǰab ẖen ẗhe ẘho ẙes ẚll ﬀ ﬂy ﬄx ﬅop ﬆop", "Straße ıdle ſtop İstanbul ẞ"]
    texts += ["a" * (n - k) + "é" * k for n, k in SHARES]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}), f"{tmp_path}/documents.parquet")
    found = entry.queries()["content_word_counts"](spark, str(tmp_path))
    ok, message = oracle.compare(found, oracle.connect(str(tmp_path)), entry.oracle_sql()["content_word_counts"])
    assert ok, message


def test_shares_are_rounded_as_the_sql_does(spark, tmp_path):
    """Of 16,000 characters 8,001 in ASCII: 0.5000625 lies below the half in binary."""
    text = "a" * 8001 + "é" * 7999
    pq.write_table(pa.table({"doc_id": pa.array([1], pa.int64()), "text": [text]}), f"{tmp_path}/documents.parquet")
    assert entry.queries()["content_word_counts"](spark, str(tmp_path)).first()["ascii_share"] == 0.500062
