"""Results do not depend on how a table's scans are split: executors that
join or leave change the splits between two scans of one table."""

import collections

import pytest
from llm_data import prose

from tagloom.llm import common, minhash, mixing, secrets, suffix

DOC = "doc_id long, text string, source string"


@pytest.fixture()
def many_files(spark, tmp_path, monkeypatch):
    """(table of 16 files, its rows); every scratch table that is written
    changes the splits of the next scan."""
    key = "AKIA" + "".join("ABCDEFGHJKLMNPQR"[i] for i in (3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8)) + "7Z"
    passage = prose(999, 130)
    rows = [(i, prose(i % 150 if i < 300 else i, 100) + (" " + passage if i % 7 == 0 else "") + (f" token = {key}{i}" if i % 11 == 0 else ""), f"s{i % 3}")
            for i in range(320)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, DOC).repartition(16, "doc_id").write.parquet(path)
    old, turn = spark.conf.get("spark.sql.files.maxPartitionBytes"), [0]
    plain = common.written

    def shifted(df, name):
        out = plain(df, name)
        turn[0] += 1
        spark.conf.set("spark.sql.files.maxPartitionBytes", str([40 << 10, 4 << 20, 6 << 10][turn[0] % 3]))
        return out

    monkeypatch.setattr(common, "written", shifted)
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    yield spark.read.parquet(path), rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_operators_survive_other_splits(spark, many_files):
    docs, rows = many_files
    groups = collections.defaultdict(list)
    for i, text, _ in rows:
        groups[text].append(i)
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert all(found[i] == found[ids[0]] for ids in groups.values() for i in ids)
    assert {r["doc_id"] for r in minhash.one_per_group(docs).collect()} == set(found.values())
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean == {i: t if " token = " not in t else t[:t.index(" token = ")] + " token = " + secrets.TAG for i, t, _ in rows}
    cut = {r["doc_id"]: r["n_removed"] for r in suffix.remove_repeats(docs).collect()}
    assert {i for i, n in cut.items() if n == 0} == {i for i, _, _ in rows if i >= 300 and i % 7}
    sized = docs.withColumn("size", mixing.word_count(docs["text"]))
    mixed = [r.asDict() for r in mixing.mix(sized, mixing.cyclic_weights(mixing.source_sizes(sized, "source", "size"))).collect()]
    for s in ("s0", "s1", "s2"):
        part = [r for r in mixed if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in part) - part[0]["target"]) < 200
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix_texts_")]
