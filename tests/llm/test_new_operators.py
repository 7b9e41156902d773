"""Turn repair, neighbour search and phrase mining against brute force."""

import collections
import hashlib
import random
import re
import sys
import zlib
from functools import cache

import numpy as np
import pytest
from llm_data import ODD, stored
from pyspark.sql import functions as F

from tagloom.llm import neighbours, phrases, queries, turns

SF_SMALL = "/root/testdata/sf0.001"

# --- turn repair ------------------------------------------------------------------------


def repaired_brute(letters, faults, start=turns.NONE, goals=(turns.NONE, turns.ASSISTANT)):
    """Least (cost, edits) by recursion over all edits."""
    @cache
    def of(i, state, inserted):
        out = [(0, "")] if i == len(letters) and state in goals else []
        follow = "a" if state == turns.USER else "u"
        options = []
        if inserted < 3:
            options.append((2, "I", i, follow, inserted + 1))
        if i < len(letters):
            options.append((3, "D", i + 1, None, 0))
            if faults[i] not in (turns.BLANK, turns.DUPLICATE):
                cut = int(faults[i] == turns.CUT)
                if letters[i] == follow or letters[i] == "s" and state == turns.NONE:
                    options.append((cut, "K", i + 1, letters[i], 0))
                options.append((2 + cut, "R", i + 1, follow, 0))
        for cost, edit, j, role, k in options:
            rest = of(j, state if role is None else turns._AFTER[role], k)
            if rest:
                out.append((cost + rest[0], edit + rest[1]))
        return min(out, default=None)
    sys.setrecursionlimit(20_000)
    return of(0, start, 0)


def test_search_finds_the_cheapest_and_least_edits():
    r = random.Random(1)
    for _ in range(1000):
        n = r.randint(0, 9)
        letters = "".join(r.choice("uuaasx?"[:r.randint(2, 7)]) for _ in range(n)).replace("x", "?")
        faults = [r.choice([0, 0, 0, 1, 2, 3, 3]) for _ in range(n)]
        for start, goals in [(0, (0, 3)), *((s, (g,)) for s in range(4) for g in range(4) if s <= g or s > 1 and g > 1)]:
            got = turns.search(letters, faults, start, goals)
            assert (got and got[:2]) == repaired_brute(letters, faults, start, goals), (letters, faults, start, goals)
            if got:
                bound = turns._Bound(letters, faults, goals)
                assert bound.of(0, start) <= got[0]


def test_search_of_a_whole_chunk():
    r = random.Random(2)
    for _ in range(5):
        letters = "".join(r.choice("uuuaaas?") for _ in range(turns.CHUNK))
        faults = [r.choice([0, 0, 1, 2, 3]) for _ in letters]
        assert turns.search(letters, faults)[:2] == repaired_brute(letters, faults)


def report_brute(rows):
    """The contract over (conv_id, turn, role, text) rows, row by row."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = convs[conv]
        if what:
            text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
            kept += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, faults, letters = set(), [], ""
        for _, role, text in kept:
            inner = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append(1 if not inner else 2 if (role, text) in seen else 3 if inner[-1] not in ".!?" else 0)
            seen.add((role, text))
            letters += role[:1] if role[:1] in tuple("sua") else "?"
        cost, audit = repaired_brute(letters, faults)
        lines, i, after = [], 0, ""
        for e in audit:
            role = "assistant" if after == "u" else "user"
            if e == "I":
                lines.append(role + ":")
            elif e == "D":
                i += 1
                continue
            else:
                role = kept[i][1] if e == "K" else role
                lines.append(f"{role}:{kept[i][2]}")
                i += 1
            after = role[0]
        known = [t for t, _, _ in kept if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        out[conv] = (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _reports(spark, df):
    rows, report = turns.repair(turns.damage(df))
    return {r[0]: tuple(r[1:]) for r in turns.digests(df, rows, report).collect()}


TURN = "conv_id long, turn long, role string, text string"


def test_reports_match_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op11_turn_repair"](spark, SF_SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == report_brute(rows)


@pytest.mark.parametrize("chunk", [turns.CHUNK, 3])
def test_odd_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(turns, "CHUNK", chunk)
    r = random.Random(3)
    texts = [*ODD[:8], "Yes.", "No!", "no", "Why? ", "Why? ", "cut off"]
    roles = ["user", "assistant", "system", None, "", "tool", "user"]
    rows = [(r.choice([None, 1, 2, 3, -4]), r.choice([None, 0, 1, 2, 5, 9, 7]), r.choice(roles), r.choice(texts)) for _ in range(150)]
    rows += [(8, i, r.choice(["user", "assistant"]), f"turn {i}" + r.choice([".", ""])) for i in range(300)]
    rows += [(1000 + i, 0, "user", "x") for i in range(60)]          # some are dropped whole
    rows += [(3, 1, "user", "word " * 20_000 + "."), (1 << 62, -(1 << 62), "user", "a."), (1 << 62, 1 << 62, "user", "a.")]
    df = stored(spark, rows, TURN).withColumn("pos", F.lit(1)).withColumn("kind", F.lit("x"))
    want = report_brute(rows)
    assert _reports(spark, df) == want
    assert any(not w[6] for w in want.values())
    assert _reports(spark, df.filter("false")) == {}


# --- nearest neighbours -------------------------------------------------------------------

VEC = "vec_id long, embedding array<double>"


def near_brute(rows, k, asks):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    out = {}
    for i, v in usable:
        if asks(i):
            c = [(-float(np.dot(v, w)), j) for j, w in usable if j != i and len(w) == len(v)]
            out[i] = sorted(c)[:k]
    return out


def _near(df, k=20, step=20):
    out = collections.defaultdict(list)
    got = neighbours.nearest(df, F.col("vec_id") % step == 0, k=k).collect()
    for q, rank, vec, score in sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got):
        assert rank == len(out[q]) + 1
        out[q].append((-score, vec))
    return out


def _recall(got, want):
    return sum(len({v for _, v in got.get(q, [])} & {v for _, v in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_neighbours_of_clusters_and_a_hot_copy(spark, monkeypatch):
    for name, value in (("LIST", 32), ("PART", 64), ("BLOCK", 50)):
        monkeypatch.setattr(neighbours, name, value)
    r = np.random.default_rng(5)
    centers = r.normal(size=(20, 12))
    rows = [(int(i), (r.choice([0.1, 1, 30]) * (centers[i % 20] + 0.4 * r.normal(size=12))).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[7][1]) for i in range(600)]              # a third are copies of one vector
    want, got = near_brute(rows, 20, lambda i: i % 20 == 0), _near(stored(spark, rows, VEC))
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert _recall(got, want) >= 0.9
    vec = collections.defaultdict(list)
    for i, v in rows:
        vec[i].append(v)
    for q, near in got.items():
        assert near == sorted(near)
        for s, v in near:
            assert abs(-s - np.dot(vec[q][0], vec[v][0])) <= 1e-9 * max(1, abs(s))
    assert neighbours.nearest(stored(spark, rows, VEC), F.col("vec_id") == 0).count() == 20


def test_odd_vectors_have_exact_neighbours(spark):
    rows = [(0, None), (20, []), (40, [0.0] * 3), (60, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]), (100, [1.0, float("inf"), 0.0]),
            (120, [1.0, 2.0, 3.0]), (7, [2.0, 4.0, 6.0]), (120, [1.0, 2.0, 3.0]), (9, [1.0, 2.0]), (140, [2.0, 1.0]), (10, [-1.0, -2.0, -3.0]),
            (160, [1e150, 2e150, 3e150]), (12, [1e-300, 2e-300, 3e-300]), (None, [1.0, 2.0, 3.0]), (13, [1.0, 2.0, 3.0]), (14, [3.0, 2.0, 1.0]),
            (180, [-0.0, 0.0, 1.0]), (15, [5.0])]
    df = stored(spark, rows, VEC).withColumn("list", F.lit(1)).withColumn("query", F.lit("clash"))
    want = near_brute(rows, 20, lambda i: i % 20 == 0)
    got = _near(df)
    assert {q: [v for _, v in near] for q, near in got.items()} == {q: [v for _, v in near] for q, near in want.items() if near}
    assert neighbours.nearest(df.filter("false")).count() == 0
    assert neighbours.nearest(df.filter("vec_id = 7"), F.col("vec_id") % 20 == 0).count() == 0


def test_registered_neighbours_reach_the_recall(spark):
    rows = [(r[0], list(map(float, r[1]))) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = collections.defaultdict(list)
    for r in queries.QUERIES["op12_posting_lists"](spark, "/root/testdata/sf0.01").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    want = near_brute(rows, 20, lambda i: i % 20 == 0)
    assert set(got) == set(want) and _recall(got, want) >= 0.9


def test_graph_finds_near_centroids():
    x = np.random.default_rng(6).normal(size=(700, 16)).astype(np.float32)
    x[:100] = x[0] + 0.001 * x[:100]
    model = neighbours.Lists.build(x)
    q = np.random.default_rng(7).normal(size=(50, 16)).astype(np.float32)
    at, d = model.nearest(q, 32)
    true = np.linalg.norm(q[:, None] - x[None], axis=2)
    assert (np.abs(d[:, 0] - true.min(axis=1)) < 1e-4).mean() > 0.8
    far = model.within(q, 1e9)
    assert all(len(f) == len(x) for f in far)                        # the graph is connected


# --- phrases ----------------------------------------------------------------------------------

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def phrases_brute(rows, least, longest=5, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").encode().translate(LOW).decode()):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    gone = {(lang, p[i:j]) for (lang, p), c in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * c >= 100 * cand[lang, p[i:j]]}
    out = []
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            s, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, -s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    ranks, res = collections.Counter(), []
    for lang, s, a, p, left, right, total in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            res.append((lang, ranks[lang], p.decode(), -a, left, right, total, -s))
    return res


TEXT = "text string, lang string"


@pytest.mark.parametrize("share", [0.05, 1.0])
def test_phrases_are_exact_whatever_the_sample(spark, share):
    r = random.Random(8)
    words = ["Alpha", "beta", "gamma", "delta", "eps", "Zeta", "\x1cq", "naïve", "ΣΑΣ"]
    rows = [(" ".join(r.choice(words[:r.randint(2, 9)]) + r.choice(["", "", "", ",", ". ", "\n", "\t "]) for _ in range(r.randint(0, 60))),
             r.choice(["en", "de", None])) for _ in range(150)]
    rows += [("over and over " * 40, "de"), (None, "en"), ("", None), (" ;;. ", "fr"), ("rare phrase of one text " * 9, "en")]
    df = stored(spark, rows, TEXT).withColumn("key", F.lit(1)).withColumn("c", F.lit("x"))
    got = sorted(tuple(x) for x in phrases.collocations(df, least=8, top=50, share=share).collect())
    assert got == phrases_brute(rows, 8, top=50) and len(got) > 20


def test_odd_phrases(spark):
    rows = [(t, lang) for t in ODD for lang in ("en", None)]
    got = sorted(tuple(x) for x in phrases.collocations(stored(spark, rows, TEXT), least=2).collect())
    assert got == phrases_brute(rows, 2)
    assert phrases.collocations(stored(spark, rows, TEXT).filter("false")).count() == 0


def test_score_arithmetic_passes_64_bits(spark):
    got = spark.sql("select (cast(1000 as decimal(4,0)) * (cast(9000000000001 as decimal(19,0)) * cast(9000000000007 as decimal(19,0))))"
                    " div (cast(3000000007 as decimal(19,0)) * cast(3000000019 as decimal(19,0))) as s").first()["s"]
    assert got == 1000 * 9000000000001 * 9000000000007 // (3000000007 * 3000000019)
