"""The object scan and its queries hold a pack of pieces, not a split."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tagloom.plans import stateful
from tagloom.sources import objects, scan


def _records(n):
    odd = ["}{", "it's }", '"}', "\\", "é}ü{", "", "}" * 40, "{" * 40]
    rows = [{"links": str(i), "views": str(i), "votes": [odd[i % 8]], "answers": [], "questions": [odd[(i * 3) % 8] * (i % 7)], "tags": [f"t{i}"]}
            for i in range(n)]
    rows[5]["questions"] = ["}{ " * 3000]           # longer than several packs, cut everywhere
    rows[n // 2]["questions"] = ["plain " * 3000]   # longer, not cut
    return rows


@pytest.mark.parametrize("closed", [True, False])
def test_no_row_holds_a_split(spark, tmpdir_path, monkeypatch, closed):
    rows = _records(3000)
    with open(tmpdir_path + "/items.json", "w") as f:
        f.write(json.dumps({"items": rows}, ensure_ascii=False) + ("" if closed else "\n"))
    if hasattr(scan, "PACK_BYTES"):
        monkeypatch.setattr(scan, "PACK_BYTES", 2000)
    plain, most = scan._written, {}

    def measured(df, name, **options):
        out = plain(df, name, **options)
        most[name] = max([out.agg(F.max(F.size(f.name))).first()[0] or 0 for f in out.schema if isinstance(f.dataType, T.ArrayType)], default=0)
        return out

    monkeypatch.setattr(scan, "_written", measured)
    got = objects.read_items_json(spark, tmpdir_path).collect()
    assert sorted((r.asDict() for r in got), key=lambda r: int(r["links"])) == rows
    assert most and max(most.values()) <= 2000, most        # the split has 72,000 pieces


def test_objects_over_packs_keep_their_place(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(scan, "PACK_BYTES", 300)
    rows = [repr(r) for r in _records(200)]
    with open(tmpdir_path + "/a.txt", "w") as f:
        f.write("\n".join(rows) + "\n{'links': 'open', 'tags': ['x}")
    found = scan.scan_objects(spark, tmpdir_path).orderBy("block", "id").collect()
    assert [r["text"].strip() for r in found] == [*rows, "{'links': 'open', 'tags': ['x}"]
    assert [r["whole"] for r in found] == [True] * 200 + [False]
    assert len({r["id"] for r in found}) == 201


def test_item_documents_of_repeated_and_null_ids(spark, tmpdir_path):
    docs = [(i // 3 if i % 7 else None, f"text }}{{ {i}" if i % 5 else None, "en" if i % 2 else None, f"s{i % 3}", 10 + i) for i in range(60)]
    docs += [(0, "x", "en", "s", 1), (0, "x", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        tmpdir_path + "/documents.parquet")
    got = stateful.QUERIES["items_records"](spark, tmpdir_path).collect()
    want = [(None if d is None else str(d), str(n), f"it's }}{{ {lang or ''} \"}}|{source}", hashlib.sha256((text or "").encode()).hexdigest(), "{|\\'")
            for d, text, lang, source, n in docs]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
