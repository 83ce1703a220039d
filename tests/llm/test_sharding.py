import hashlib
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from triplex.llm.sharding import SEED, assign_shards, interleave, write_shards


def brute(rows, shards):
    """Positions by definition, with exact fractions."""
    by_source = {}
    for doc_id, text, source in rows:
        key = hashlib.md5(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        crc = zlib.crc32((text or "").encode())
        by_source.setdefault(source, []).append((key, doc_id, crc, len((text or "").encode()) + 1))
    order = []
    for source, members in by_source.items():
        for r, m in enumerate(sorted(members, key=lambda m: (m[0], m[2]))):
            order.append((Fraction(2 * r + 1, 2 * len(members)), source is not None, source or "", *m))
    order.sort(key=lambda x: x[:5])
    out, slots = [], Counter()
    for p, (_, _, _, _, doc_id, crc, size) in enumerate(order):
        s = p * shards // len(order)
        out.append((doc_id, size, crc, s, slots[s]))
        slots[s] += 1
    return sorted(out, key=repr)


ROWS = [(i, f"text {i}" if i % 7 else None, ("hot" if i % 3 else f"s{i % 5}") if i % 11 else None) for i in range(500)]
ROWS += [(900, "é" * 50_000, "long"), (901, "", "long"), (902, "tie", "hot"), (902, "tie", "hot"), (903, "x", "")]


@pytest.mark.parametrize("shards,buckets", [(16, 4096), (7, 4), (1, 1)])
def test_against_brute_force(make_docs, shards, buckets):
    got = assign_shards(make_docs(ROWS), shards, buckets=buckets).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=repr) == brute(ROWS, shards)


def test_counts_and_mixture(make_docs):
    got = assign_shards(make_docs(ROWS), 16).collect()
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    hot = Counter(r.shard for r in got if r.source == "hot")
    assert max(hot.values()) - min(hot.values()) <= 4


def test_fewer_rows_than_shards_and_empty(make_docs):
    got = assign_shards(make_docs(ROWS[:5]), 16).collect()
    assert len({r.shard for r in got}) == 5 and all(r.slot == 0 for r in got)
    assert assign_shards(make_docs([]), 16).count() == 0


def test_positions_are_gapless(make_docs):
    got = sorted(r.position for r in interleave(make_docs(ROWS)).select("position").collect())
    assert got == list(range(len(ROWS)))


def test_written_shards_hold_every_row(spark, make_docs, tmp_path):
    docs = make_docs(ROWS[:300])
    write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.select("doc_id").collect()) == list(range(300))
    assert [r["count"] for r in back.groupBy("shard").count().orderBy("shard").collect()] == [75] * 4
