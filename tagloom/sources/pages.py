"""Fields out of already fetched web pages (the crawler's parse step).

Patterns are Java regular expressions evaluated by Spark's own
``regexp_extract`` / ``regexp_extract_all`` (JVM side, no Python). A
page may be cut into blocks first (one record per block, e.g. each
question of a listing page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns for the `pages` table markup.
PAGE_FIELDS = {
    "title": (r"<title>(.*?)</title>", "one"),
    "heading": (r"<h1>(.*?)</h1>", "one"),
    "tags": (r'<li><a href="/[^"]*">([^<]*)</a></li>', "all"),
    "links": (r'<li><a href="/([^"]*)">', "all"),
}

# Patterns for a question listing page, one block per question.
QUESTION_BLOCK = r'<div class="question-summary'
QUESTION_FIELDS = {
    "votes": (r'<span class="vote-count-post[^"]*"><strong>([^<]*)</strong>', "all"),
    "answers": (r'<div class="status[^"]*">\s*<strong>([^<]*)</strong>', "all"),
    "views": (r'<div class="views[^"]*" title="([0-9,]+) views"', "one"),
    "questions": (r'<h3><a href="[^"]*" class="question-hyperlink">([^<]*)</a></h3>', "all"),
    "links": (r'<h3><a href="/[^/"]*/([^/"]*)', "one"),
    "tags": (r'js-post-tag-list-item[^"]*"><a[^>]*>([^<]*)</a>', "all"),
}


# The named entities that are decoded, and their code points.
ENTITIES = {"amp": 38, "lt": 60, "gt": 62, "quot": 34, "apos": 39, "nbsp": 160}
_ENTITY = "&(?=#[0-9]{1,7};|#[xX][0-9a-fA-F]{1,6};|(?:" + "|".join(ENTITIES) + ");)"


def decode_entities(c: Column) -> Column:
    """Text with ``&name;`` (``ENTITIES``), ``&#N;`` and ``&#xN;`` decoded
    once; anything else that starts with ``&`` stays as it is."""
    pieces = F.split(c, _ENTITY, -1)
    named = F.create_map(*(F.lit(x) for k, v in ENTITIES.items() for x in (k, v)))

    def decoded(p):
        name = F.substring_index(p, ";", 1)
        hexed = F.conv(F.regexp_extract(name, "^#[xX](.+)$", 1), 16, 10)
        code = F.coalesce(F.try_element_at(named, name), F.nullif(hexed, F.lit("")).cast("int"),
                          F.nullif(F.regexp_extract(name, "^#([0-9]+)$", 1), F.lit("")).cast("int"))
        ok = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(ok, F.concat(char, p.substr(F.length(name) + 2, F.length(p)))).otherwise(F.concat(F.lit("&"), p))

    rest = F.transform(F.slice(pieces, 2, F.size(pieces)), decoded)
    return F.when(~c.contains("&"), c).otherwise(F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, "")))


def _extract(c, pattern: str, kind: str):
    """The first match (null if the field is absent), or all matches."""
    if kind == "all":
        return F.regexp_extract_all(c, F.lit(pattern), 1)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def _decoded(c, kind: str):
    return F.transform(c, decode_entities) if kind == "all" else decode_entities(c)


def extract_records(pages: DataFrame, fields: dict = PAGE_FIELDS, html_col: str = "html",
                    block_pattern: str | None = None, max_blocks: int | None = None,
                    keep: list | None = None) -> DataFrame:
    """One row per page (or per block), one column per field pattern.

    With ``block_pattern`` the page is split before each match and the
    text before the first block is dropped; every block of a page is kept
    unless ``max_blocks`` is given. An absent field is null (``one``) or an
    empty list (``all``); entities in extracted text are decoded.
    """
    keep = keep if keep is not None else ["page_id"]
    if block_pattern:
        src = (pages.select(*keep, F.posexplode(F.split(F.col(html_col), block_pattern))
                            .alias("block_no", "_block"))
               .filter(F.col("block_no") > 0))
        if max_blocks:
            src = src.filter(F.col("block_no") <= F.lit(max_blocks))
        keep = keep + ["block_no"]
    else:
        src = pages.select(*keep, F.col(html_col).alias("_block"))
    # matches first, decoding on top: the planner keeps the two apart since
    # decoding reads a match several times
    found = src.select(*keep, *[_extract(F.col("_block"), p, k).alias(n) for n, (p, k) in fields.items()])
    return found.select(*keep, *[_decoded(F.col(n), k).alias(n) for n, (_, k) in fields.items()])


def extract_questions(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Question rows of listing pages; ``views`` digits without commas."""
    q = extract_records(pages, QUESTION_FIELDS, html_col, QUESTION_BLOCK)
    return q.withColumn("views", F.replace(F.col("views"), F.lit(","), F.lit("")))
