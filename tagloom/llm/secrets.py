"""Secret scans judged by corpus-wide ownership frequency.

Candidates are found by patterns. Their values are hashed, and each hash
is counted over distinct repositories (documents) and owners (sources) of
the whole corpus: a value that ``EXAMPLE_OWNERS`` or more owners share is
a widely copied example; a value of few owners that looks random is a live
credential. Only DataFrame functions are used.

Offsets count code points. A pattern's match offsets come from cutting the
text at its matches: the pieces between and the matches alternate, so a
match starts after all earlier pieces and matches (a running sum per
document over one row per match; texts are not shuffled).

Hot values: rows are first made distinct by (value, owner, document), then
counted by (value, owner), then by value, each with a map-side partial.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm import common

# Fixed patterns (kind: pattern, group of the value, least length of the value).
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
    # found by the method only: long mixed tokens, a secret if few own them
    "blob": (r"[A-Za-z0-9+/_-]{24,}", 0, 24),
}
BASE = ("assign", "access", "hex")
ORDER = ("assign", "access", "hex", "live", "blob")
# Words, numbers and abbreviations; a capital belongs to the small letters after it.
PIECE = "[A-Z]?[a-z]+|[A-Z]+|[0-9]+"
EXAMPLE_OWNERS = 3
TAG = "[SECRET]"


def _found(text: Column, kind: str) -> Column:
    """array<struct<kind, gap, hit, value>>: every match of a pattern,
    ``gap`` code points after the one before it."""
    pattern, group, _ = KINDS[kind]
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def entry(gap, hit):
        value = F.regexp_extract(hit, pattern, group) if group else hit
        return F.struct(F.lit(kind).alias("kind"), F.length(gap).cast("long").alias("gap"),
                        F.length(hit).cast("long").alias("n"), value.alias("value"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, entry)
    return F.when(text.rlike(pattern), pairs).otherwise(F.array().cast(
        "array<struct<kind:string,gap:bigint,n:bigint,value:string>>"))


def candidates(docs: DataFrame, text_col: str = "text", owner_col: str = "source",
               keep: tuple[str, ...] = (), row: Column | None = None) -> DataFrame:
    """``row`` (a stored row number, or else the document's place in this
    scan of ``docs``: store the result before it is used twice), ``owner``,
    the columns in ``keep`` and ``found``, of every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.monotonically_increasing_id() if row is None else row
    return docs.select(*keep, row.alias("row"), F.col(owner_col).alias("owner"),
                       F.concat(*(_found(text, k) for k in KINDS)).alias("found"))


def located(found: DataFrame) -> DataFrame:
    """``row, owner, kind, start, end, value`` of each candidate that is
    long enough; short matches are dropped after they have been stepped
    over."""
    least = F.create_map(*(F.lit(x) for k, (_, _, n) in KINDS.items() for x in (k, n)))
    order = Window.partitionBy("row", "kind").orderBy("i")
    hits = found.select("row", "owner", F.posexplode("found").alias("i", "f")).select("row", "owner", "i", "f.*")
    end = F.sum(F.col("gap") + F.col("n")).over(order)
    return (hits.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))
            .filter(F.length("value") >= least[F.col("kind")])
            .select("row", "owner", "kind", "start", "end", "value"))


def looks_live(value: Column) -> Column:
    """Random-looking: letters and digits, at least 8 different characters,
    and none of the words examples are made of."""
    letters = F.array_distinct(F.split(value, ""))
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(letters) >= 8)
            & ~value.rlike("(?i)example|sample|dummy|changeme|placeholder|your_|xxxx"))


def looks_random(value: Column) -> Column:
    """Mixes upper and lower case letters and digits, not in the way of
    paths and identifiers: more than two changes of case or digit to 9
    letters, those at ``+ / _ -`` aside, or one to 3 in a part of 8 or more
    (random letters and digits: one to 2)."""
    n = F.length(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    inner = F.regexp_count(value, F.lit(PIECE)) - F.regexp_count(value, F.lit("[A-Za-z0-9]+"))
    part = F.exists(F.split(value, "[+/_-]+"),
                    lambda s: (F.length(s) >= 8) & (F.length(s) < 3 * F.regexp_count(s, F.lit(PIECE))))
    return (value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")) & ((2 * n < 9 * inner) | part)


def ownership(hits: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``hash, repositories, owners, verdict`` of every candidate value:
    ``example``, ``live`` or ``other``. A null owner is an owner."""
    one = hits.select(F.md5("value").alias("hash"), "owner", "row",
                      ((F.col("kind") == "access") | looks_live(F.col("value"))).alias("looks")).distinct()
    by_owner = one.groupBy("hash", "owner", "looks").agg(F.count(F.lit(1)).alias("repositories"))
    values = by_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"),
                                          F.count(F.lit(1)).alias("owners"), F.max("looks").alias("looks"))
    return values.select("hash", "repositories", "owners",
                         F.when(F.col("owners") >= example_owners, "example")
                         .when(F.col("looks"), "live").otherwise("other").alias("verdict"))


def judged(found: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Candidates with the verdict on their value. A ``blob`` must look
    random: paths and identifiers are none."""
    hits = located(found).filter((F.col("kind") != "blob") | looks_random(F.col("value")))
    hits = common.written(hits, "secret-hits")
    verdicts = common.written(ownership(hits, example_owners), "secret-values")
    return (hits.withColumn("hash", F.md5("value")).join(verdicts.select("hash", "owners", "verdict"), "hash")
            .drop("hash"))


def scan(found: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Per document with candidates: ``row``, the sorted ``base`` spans
    (assign, access, hex) and all ``spans``, each ``kind:start:end``, their
    ``counts`` by kind, and ``live_spans`` as array<struct<start,end>>.

    The method adds a ``live`` span over the value of each live base
    candidate and ``blob`` spans of live mixed tokens.
    """
    c = judged(found, example_owners)
    live = F.col("verdict") == "live"
    base = F.col("kind") != "blob"
    value_start = F.col("end") - F.length("value")
    named = F.array(
        F.when(base, F.struct(F.col("start").alias("start"), F.col("kind").alias("kind"), F.col("end").alias("end"))),
        F.when(base & live, F.struct(value_start.alias("start"), F.lit("live").alias("kind"), F.col("end").alias("end"))),
        F.when(~base & live, F.struct(F.col("start").alias("start"), F.lit("blob").alias("kind"), F.col("end").alias("end"))))
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(ORDER) for x in (k, i)))
    spans = (c.select("row", F.when(F.col("verdict") == "example", 1).otherwise(0).alias("example"),
                      F.explode(F.filter(named, lambda s: s.isNotNull())).alias("s"))
             .select("row", "example", F.struct("s.start", rank[F.col("s.kind")].alias("rank"), "s.end", "s.kind").alias("s")))
    per_doc = spans.groupBy("row").agg(F.sort_array(F.collect_set("s")).alias("all"),
                                       F.sum("example").alias("n_example"))

    def text_of(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def of_kind(*kinds):
        return lambda s: s["kind"].isin(*kinds)

    return per_doc.select(
        "row", "n_example",
        *(F.size(F.filter("all", of_kind(k))).cast("long").alias(f"n_{k}") for k in ORDER),
        F.array_join(F.transform(F.filter("all", of_kind(*BASE)), text_of), ",").alias("base"),
        F.array_join(F.transform("all", text_of), ",").alias("spans"),
        F.transform(F.filter("all", of_kind("live", "blob")),
                    lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("live_spans"))


def redact(docs: DataFrame, text_col: str = "text", owner_col: str = "source",
           example_owners: int = EXAMPLE_OWNERS, tag: str = TAG) -> DataFrame:
    """``docs`` with every live credential replaced by ``tag``; widely
    copied examples stay. All rows and columns are kept.

    Null texts stay null; a null owner counts as an owner; repeated rows
    are documents of their own. Rows are told apart by a number that is
    stored with them once. An empty table stays empty. Column names of
    ``docs`` cannot clash with the operator's own.
    """
    rows = common.numbered(docs.select(F.struct(*docs.columns).alias("doc")), "secret-rows")
    found = common.written(candidates(rows, f"doc.{text_col}", f"doc.{owner_col}", row=F.col("row")), "secret-found")
    spans = common.written(scan(found, example_owners).filter(F.size("live_spans") > 0).select("row", "live_spans"),
                           "secret-spans")
    text = F.col("doc")[text_col]

    def step(acc, s):
        fresh = s["start"] >= acc["pos"]
        return F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(fresh, F.concat(acc["out"], text.substr(acc["pos"].cast("int") + 1, (s["start"] - acc["pos"]).cast("int")),
                                   F.lit(tag))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit("").alias("out"))
    clean = F.aggregate("live_spans", start, step,
                        lambda a: F.concat(a["out"], text.substr(a["pos"].cast("int") + 1, F.length(text))))
    new = F.when(F.col("live_spans").isNull(), text).otherwise(clean)
    return (rows.join(spans, "row", "left")
            .select(*(new.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns)))
