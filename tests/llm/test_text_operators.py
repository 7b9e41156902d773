"""Fingerprints, id files, packing, near and exact dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import ODD, odd_documents, prose, stored

from tagloom.llm import common, cws, idcodec, minhash, packing, suffix
from tagloom.llm.tokens import WordEncoder, encoder, tokenizer_path
from tagloom.session import scratch_path

DOC = "doc_id long, text string"


def reference_ids(text):
    tok = encoder(tokenizer_path()).tok
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


# --- words to ids -------------------------------------------------------------

def test_ids_equal_the_library():
    texts = ODD + ["don't, we'll. 'sun 're", "a.b,c  12 3x", "ﬁ Ǆ ß", "J̌ KK", prose(1, 300)]
    ids, n = encoder(tokenizer_path()).encode(pa.array(texts, pa.string()))
    at = 0
    for t, k in zip(texts, n, strict=True):
        assert ids[at:at + k].tolist() == reference_ids(t)[:-1].tolist()
        at += k


def test_known_units_are_columns_and_encoded_once():
    enc, texts = WordEncoder(tokenizer_path()), pa.array(ODD + ["J̌ KK a.b,c", prose(2, 400)], pa.string())
    ids, n = enc.encode(texts)
    assert isinstance(enc.units, pa.Array) and len(enc.units) == len(enc.lens) == len(set(enc.units.to_pylist()))
    tok, enc.tok = enc.tok, None                # a second pass does not ask the library
    again = enc.encode(texts)
    assert (ids == again[0]).all() and (n == again[1]).all()
    enc.tok, enc.max_units = tok, 1             # forgets its units and learns them anew
    again = enc.encode(texts)
    assert (ids == again[0]).all() and (n == again[1]).all()


def test_crc_of_joined_pieces():
    a, b = b"left" * 99, b"right!" * 1001
    assert common.crc32_concat(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert common.crc32_concat(zlib.crc32(a), 0, 0) == zlib.crc32(a)


# --- fingerprints ---------------------------------------------------------------

def _terms(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", text or "") if w]
    return Counter(words) + Counter(zip(words, words[1:]))


def test_fingerprints_estimate_generalised_jaccard():
    texts = [prose(i, 200) for i in range(8)]
    texts += [" ".join(t.split()[:150] + prose(50 + i, 50).split()) for i, t in enumerate(texts)]
    got = cws.samples(pa.array(texts))
    errors = []
    for i in range(8):
        a, b = _terms(texts[i]), _terms(texts[i + 8])
        true = sum((a & b).values()) / sum((a | b).values())
        errors.append(cws.likeness(got[i], got[i + 8]) - true)
    assert abs(np.mean(errors)) < 0.06 and max(map(abs, errors)) < 0.25


def test_edited_texts_and_next_documents(spark):
    docs = odd_documents(spark)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in cws.against_next(docs).collect())
    want = Counter()
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        edited = t[:len(t) - len(t) // 4] + u[:len(t) // 4]
        own = cws.as_text(cws.samples(pa.array([t])))[0]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own] += 1
    assert got == want
    assert cws.against_next(docs.filter("false")).count() == 0
    one = cws.against_next(stored(spark, [(1, "a b c d")], DOC)).collect()[0]
    assert one["near_next"] == 1.0
    equal = cws.fingerprint(docs.withColumnRenamed("found", "fingerprint")).filter("text = 'same row'").collect()
    assert len({r["fingerprint"] for r in equal}) == 1 and len(equal) == 2


# --- id files ---------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 255, 4096, 4097, 30_000])
def test_codec_round_trip(n):
    r = np.random.default_rng(n)
    for ids in (r.integers(0, 49408, n), np.full(n, 7), r.integers(0, 3, n), r.zipf(1.3, n) % 49408):
        coded = idcodec.encode_group([ids], 49408)
        assert (idcodec.decode_group(coded, 49408)[0][:n] == ids).all()


def test_codec_uses_its_predictions_and_checks_blocks():
    ids = np.tile(np.arange(50), 2000)
    docs = idcodec.Docs(np.array([3]), np.array([len(ids)]), np.array([6]))
    data = idcodec.pack_block(idcodec.encode_group([ids], 49408)[0], ids, docs, 49408, 11, 2)
    assert len(data) < len(ids) * 2 / 3
    [(_, back, start, doc, out)] = list(idcodec.decode_blocks([data]))
    assert (out == ids).all() and (start, doc) == (11, 2) and back.doc_id.tolist() == [3]
    damaged = bytearray(data)
    damaged[-len(data) // 3] ^= 64
    with pytest.raises(ValueError, match="checksum"):
        list(idcodec.decode_blocks([bytes(damaged)]))


def test_id_files_of_cut_and_odd_documents(spark, monkeypatch):
    docs = odd_documents(spark)
    long = docs.filter("n_chars > 50000").selectExpr("doc_id + 100 as doc_id", "repeat(text, 30) as text")
    docs = docs.select("doc_id", "text").unionAll(long)
    path = scratch_path(spark, "test-ids")
    idcodec.write_ids(docs, path)
    assert idcodec.read_ids(spark, path).filter("not whole").count() > 1      # a document over two blocks
    got = idcodec.documents_of(idcodec.read_ids(spark, path)).withColumn("at", idcodec.file_starts(spark, path))
    got = sorted(((r["at"] + r["start"], r["doc_id"], r["n_ids"], r["ids_crc32"]) for r in got.collect()),
                 key=lambda r: r[0])
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for g, (i, t) in zip(got, rows, strict=True):
        ids = reference_ids(t)
        assert g == (start, i, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    empty = scratch_path(spark, "test-ids")
    idcodec.write_ids(docs.filter("false"), empty)
    assert idcodec.documents_of(idcodec.read_ids(spark, empty)).count() == 0


# --- packing ------------------------------------------------------------------------

def test_plan_covers_every_id_once_and_fills_windows():
    for seed in range(300):
        r = random.Random(seed)
        pieces = [(r.choice([1, 5, 256, 257, 1024, 1500, 2047, 2048, 5000, r.randint(1, 4000)]), i, r.choice([0, 7]))
                  for i in range(r.choice([0, 1, 2, 5, 50, 200]))]
        for last in (False, True):
            out, rest = packing.plan_group(pieces, packing.TIERS, last)
            seen = {}
            for window, chosen in [*out, (0, rest)]:
                total = sum(n for n, _, _ in chosen)
                assert not window or total == window or (last and total < 2048)
                for n, i, start in chosen:
                    seen.setdefault(i, []).append((start, n))
            for n, i, start in pieces:
                at = start
                for s, k in sorted(seen[i]):
                    assert s == at and k > 0
                    at += k
                assert at == start + n


def test_step_groups_are_balanced():
    seqs = [(2048, [(2048, 0, 0)])] * 40 + [(256, [(128, 0, 0), (128, 1, 0)])] * 64
    steps = packing.deal_steps(seqs, 1 << 14)
    load = Counter()
    for (w, _), s in zip(seqs, steps, strict=True):
        load[s] += w
    assert max(load.values()) - min(load.values()) <= 2048


def test_pack_odd_documents(spark):
    docs = odd_documents(spark)
    rows = packing.pack(docs, group_ids=5000).collect()
    by_seq, ids = {}, Counter()
    for r in rows:
        part = np.frombuffer(r["ids"], "<u4")
        assert len(part) == r["length"]
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids[r["doc_id"], r["start"], r["ids"], r["doc_tokens"]] += 1
    for pieces in by_seq.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    assert sum(r["length"] for r in rows) == sum(len(reference_ids(t)) for t in ODD)
    assert packing.pack(docs.filter("false")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tiers=(2048, 1000))


# --- near duplicates -------------------------------------------------------------------

def _near_brute(rows):
    import re
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((rows[i][0], len(sets[i]), least.get(root(i))) for i in range(len(rows)))


def _copies(seed, n):
    """Copies of one text with edits of different weight, around the bound."""
    base, out = prose(seed, 120).split(), []
    for i in range(n):
        r, w = random.Random(1000 * seed + i), list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"edit{r.random()}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_brute_force(spark):
    texts = [t for s in range(4) for t in _copies(s, 25)] + [prose(100 + i, 80) for i in range(20)]
    texts += [texts[0].upper(), texts[0], "a b", "A  b", "a b c", "", None, " \t"]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    docs = stored(spark, rows, DOC)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect())
    assert got == _near_brute(rows)
    kept = minhash.one_per_group(docs)
    groups = {c for _, _, c in _near_brute(rows)}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == groups


def test_near_duplicates_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect())
    assert got == _near_brute(rows)
    assert minhash.near_duplicates(docs.filter("false")).count() == 0


def test_members_beside_the_main_component_still_meet(spark, monkeypatch):
    # a chain a-b-c: c is near b only, and the pivot of their buckets is a
    monkeypatch.setattr(minhash, "BLOCK", 2)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        w = list(base)
        for k in range(4 * i, 4 * i + 9):
            w[k] = f"x{i}-{k}"
        rows.append((i, " ".join(w)))
    docs = stored(spark, rows, DOC)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect())
    assert got == _near_brute(rows)


# --- repeated byte strings -------------------------------------------------------------

def _repeats_brute(rows, w):
    counts = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        counts.update(b[s:s + w] for s in range(len(b) - w + 1))
    out = Counter()
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - w + 1):
            if counts[b[s:s + w]] > 1:
                gone[s:s + w] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def _repeats(docs, w):
    return Counter(tuple(r) for r in suffix.remove_repeats(docs, window=w)
                   .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize("hot", [5, 2048])
def test_repeats_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    monkeypatch.setattr(suffix, "SHARD_BYTES", 8000)
    monkeypatch.setattr(suffix, "CHUNK", 3000)
    r = random.Random(3)
    passage = "".join(r.choice("abcdefg h") for _ in range(2500))
    rows = []
    for i in range(60):
        a = r.randint(0, 700)
        rows.append((i, "".join(r.choice("xyz é") for _ in range(r.randint(0, 60)))
                     + passage[a:a + r.randint(50, 900)] + "".join(r.choice("xyz ") for _ in range(r.randint(0, 60)))))
    rows += [(100, None), (101, ""), (102, "be " * 300), (103, "q" * 99), (104, "q" * 100), (105, "q" * 101),
             (106, passage), (106, passage), (None, passage[1200:1500])]
    docs = stored(spark, rows, DOC)
    assert _repeats(docs, 100) == _repeats_brute(rows, 100)
    assert suffix.remove_repeats(docs.filter("false"), window=100).count() == 0


def test_ranges_of_hot_windows_grow_with_them():
    assert suffix.ranges_of(1) == 64
    for windows in (10**9, 10**11):
        assert 8 * windows / suffix.ranges_of(windows) <= suffix.RANGE_BYTES
    prints = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 50_000, np.uint64, endpoint=False))
    for ranges in (64, 1000):
        edges = suffix.range_edges(prints, ranges)
        assert edges[0] == 0 and edges[-1] == len(prints) and len(edges) == ranges + 1
        assert np.diff(edges).max() < 2 * len(prints) / ranges and (np.diff(edges) >= 0).all()


def test_repeats_over_many_ranges_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", 5)
    monkeypatch.setattr(suffix, "SHARD_BYTES", 8000)
    monkeypatch.setattr(suffix, "RANGE_BYTES", 80)
    used = []
    across = suffix._across
    monkeypatch.setattr(suffix, "_across", lambda hot, ranges, window: used.append(ranges) or across(hot, ranges, window))
    r = random.Random(8)
    passage = "".join(r.choice("abcdefg h") for _ in range(1500))
    rows = [(i, prose(i, 5) + passage[(a := r.randint(0, 600)):a + r.randint(150, 900)] + prose(90 + i, 5)) for i in range(50)]
    docs = stored(spark, rows, DOC)
    assert _repeats(docs, 100) == _repeats_brute(rows, 100)
    assert used[0] > 64


def test_repeats_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 50_000]
    assert _repeats(docs.filter("text is null or length(text) < 50000"), 400) == _repeats_brute(rows, 400)


def test_suffix_ranks_and_prefixes():
    r = np.random.default_rng(2)
    data = r.integers(97, 99, 3000).astype(np.uint8)
    data[1500:2300] = data[100:900]
    rank = suffix.suffix_ranks(data, 64)
    text = data.tobytes() + bytes(64)
    order = sorted(range(3000), key=lambda i: text[i:i + 64])
    assert all((text[a:a + 64] == text[b:b + 64]) == (rank[a] == rank[b]) and rank[a] <= rank[b]
               for a, b in zip(order, order[1:], strict=False))
    a = np.arange(50, 900)
    got = suffix.kasai(data, a, a + 1400, 300)
    for i, j, n in zip(a.tolist(), (a + 1400).tolist(), got.tolist(), strict=True):
        true = next((k for k in range(300) if text[i + k] != text[j + k]), 300)
        assert n == true
