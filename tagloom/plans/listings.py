"""Registered queries of nested markup and of chunks appended run by run,
with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.session import scratch_path
from tagloom.sinks.text import append_token_chunks, read_token_chunks
from tagloom.sources.markup import question_rows, select_paths
from tagloom.sources.pages import extract_records
from tagloom.sources.tables import table

RUNS = 3


# --- markup --------------------------------------------------------------------

def q_page_outline(spark, sf_dir):
    """Navigation texts, advertisements, footer and the number of
    paragraphs under the article, by element path."""
    return select_paths(table(spark, sf_dir, "pages"),
                        {"tags": "//nav/ul/li/a/text()", "links": "//nav/ul/li/a/@href",
                         "ads": '//div[@class="ad"]/text()', "footer": "//footer/text()"},
                        {"n_paragraphs": "//article//p"}).drop("block_no")


def _html(c):
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def q_page_questions(spark, sf_dir):
    """Each page's navigation entries rendered as a listing of questions,
    with nested, unclosed and misleading markup, and read back."""
    entries = extract_records(table(spark, sf_dir, "pages"))
    number = F.col("page_id") + 1000
    views = F.concat(F.floor(number / 1000).cast("string"), F.lit(","), F.lpad((number % 1000).cast("string"), 3, "0"))

    def block(tag, i):
        text, at = _html(tag), i.cast("string")
        return F.concat(
            F.lit("\n<div class=question-summary id=q"), at, F.lit("><!-- </div> --><div><div>x</div><div><DIV><div><span><strong>"),
            F.length(tag).cast("string"), F.lit("</strong></span></div></DIV></p><div><i>of</i><strong>"), at,
            F.lit('</strong></div></div><div title="\n '), views, F.lit(' views">seen<br></div></div><script>"</div>"</script><div><h3><a href="/questions/'),
            F.col("page_id").cast("string"), F.lit("-"), at, F.lit('/slug">'), text,
            F.lit('<b>nested <i>text</b></a></h3><ul><li class="d-inline mr4 js-post-tag-list-item"><a href="/t">'), text,
            F.lit('</a><li class="other"><a>no</a><li class="d-inline mr4 js-post-tag-list-item"><p><a>deeper</a></ul></div></div>'))

    listing = F.concat(F.lit('<html><body><div>aside</div><div id="questions">'), F.array_join(F.transform("tags", block), ""),
                       F.lit("</div><div>after</div>"))
    return question_rows(entries.select("page_id", listing.alias("html")))


# --- chunks --------------------------------------------------------------------

def q_token_chunks_appended(spark, sf_dir):
    """Documents in three runs by ranges of their ids, the second repeated,
    appended to one set of chunks and read back."""
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "appended")
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    step = ((hi or 0) - (lo or 0)) // RUNS + 1
    run_of = F.coalesce(F.floor((F.col("doc_id") - F.lit(lo or 0)) / F.lit(step)), F.lit(0))
    for run in (0, 1, 1, 2):
        append_token_chunks(docs.filter(run_of == run), path, run)
    return read_token_chunks(spark, path)


QUERIES = {
    "page_outline": q_page_outline,
    "page_questions": q_page_questions,
    "token_chunks_appended": q_token_chunks_appended,
}


def sql(known: dict[str, str], footer: str) -> dict[str, str]:
    """SQL of these queries; ``known`` are those of the others, ``footer``
    the text of the footer (nothing is shared with the parser)."""
    article = "case when strpos(html, '<article>') > 0 then substr(html, strpos(html, '<article>')) else '' end"
    ads = "[substr(x, 1, strpos(x, '<') - 1) for x in string_split(html, '<div class=\"ad\">')[2:]]"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        ads = f"list_transform({ads}, lambda x: replace(x, '&{name};', '{char}'))"
    footer = footer.replace("html", "replace(replace(html, '&copy;', '©'), '&middot;', '·')")
    return {
        "page_outline": f"""
          select f.page_id, f.tags, [('/' || x) for x in f.links] as links,
                 {ads} as ads,
                 case when {footer} is null then []::varchar[] else [{footer}] end as footer,
                 cast((length({article}) - length(replace({article}, '<p>', ''))) // 3 as bigint) as n_paragraphs
          from ({known['page_fields']}) f join pages p on p.page_id = f.page_id""",
        "page_questions": f"""
          with t as (select page_id, unnest(tags) as tag, unnest(range(len(tags))) as i from ({known['page_fields']}))
          select page_id, i + 1 as block_no, [cast(length(tag) as varchar)] as votes, [cast(i as varchar)] as answers,
                 cast(page_id + 1000 as varchar) as views, case when tag = '' then []::varchar[] else [tag] end as questions,
                 page_id || '-' || i as links, case when tag = '' then []::varchar[] else [tag] end as tags
          from t""",
        "token_chunks_appended": known["token_chunks"],
    }
