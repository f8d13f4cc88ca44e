"""List and detail pages around the postings, for the queries on nodes.

Each page is built so that its answer is known from the posting: the SQL of these
queries computes it from the posting's fields, not from the page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.postings import raw_postings

FILLER = "The quick brown fox jumps over the lazy dog near the river bank"
HOST = "https://jobs.example.com"

#: a posting's working form on its card, in Spark's and the oracle's integer division
FORM = "CASE (post_id {div} 6) % 4 WHEN 0 THEN 'Fulltime' WHEN 1 THEN 'Remote' WHEN 2 THEN 'Hybrid' ELSE 'Onsite' END"
CARD = f"""CASE post_id % 6
  WHEN 0 THEN '<div class="x rounded-xl"><span>Contract</span><div>' || link || '</div><p>{FILLER}</p><div class="grid grid-cols-3"><span>Hanoi</span><span><i>' || form || '</i></span></div></div>'
  WHEN 1 THEN '<div class=rounded-xl><h3>' || link || '</h3><p>{FILLER}</p><span>' || form || ' and many other ways of working</span><span> ' || lower(form) || '</span></div>'
  WHEN 2 THEN '<article>1,000 USD {FILLER}<span>' || form || '</span>{"<div>" * 8}' || link || '{"</div>" * 8}</article>'
  WHEN 3 THEN '<article>1,000 USD {FILLER}<span>' || form || '</span>{"<div>" * 11}' || link || '{"</div>" * 11}</article>'
  WHEN 4 THEN '<div class="rounded-xl"><a href="/detail-jobs/' || id || '">Apply now</a><a href="/company/9">Acme</a>' || link || '{FILLER}<ul><li>x<li><span>' || form || '</span></ul></div>'
  ELSE '<div>Negotiable {FILLER}<div>VND ' || link || '</div><br><span>' || form || '</span></div>' END"""
LINK = """'<a href="' || CASE post_id % 3 WHEN 0 THEN '/detail-jobs/' WHEN 1 THEN '../detail-jobs/' ELSE 'https://jobs.example.com/detail-jobs/' END
  || id || '?from=list#top"><b>' || title || '</b> ' || CAST(post_id AS VARCHAR(20)) || '</a>'"""


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of ten cards (page_id, url, html)."""
    form = FORM.format(div="DIV")
    cards = (raw_postings(spark, sf_dir).selectExpr("post_id", "title", "CAST(post_id % 3000 AS VARCHAR(20)) AS id", f"{form} AS form")
             .withColumn("link", F.expr(LINK)).select("post_id", F.expr(CARD).alias("card")))
    ten = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("post_id", "card"))), lambda c: c["card"]), "<hr>")
    return cards.groupBy(F.expr("post_id DIV 10").alias("page_id")).agg(ten.alias("cards")).select(
        "page_id", F.concat(F.lit(f"{HOST}/it-jobs/all?page="), F.col("page_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body><nav><span>Hybrid</span><a href='/about'>About</a></nav><!-- <a href='/detail-jobs/1'>no</a> -->"), F.col("cards"),
                 F.lit("<script>'<span>Remote</span>'</script></body></html>")).alias("html"))


LONG_TEXT = "word " * 40
LABEL_PAGE = f"""'<html><body><div class="h"><h1>Job</h1></div>{"<div>" * 9}' || CASE post_id % 6
  WHEN 0 THEN '<div><span>Industry</span><span>' || v || '</span></div>'
  WHEN 1 THEN '<p>Industry: ' || v || '</p>'
  WHEN 2 THEN '<div><label>Industry</label><em></em><i>View company</i><u>Lĩnh vực</u><b>' || v || '</b></div>'
  WHEN 3 THEN '<div>' || v || ' <span>Industry</span></div>'
  WHEN 4 THEN '<p>No such label</p>'
  ELSE '<div><span>Industry</span>{f"<p>{LONG_TEXT}</p>" * 4}<p>' || v || '</p></div>' END || '{"</div>" * 9}'
  || CASE WHEN post_id % 6 < 4 THEN '<p>Industry: Other</p>' ELSE '' END || '</body></html>'"""


def label_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (raw_postings(spark, sf_dir).selectExpr("post_id", "'Field ' || CAST(post_id % 50 AS VARCHAR(9)) AS v")
            .select("post_id", F.expr(LABEL_PAGE).alias("html")))


RELATED = '<section><div><a href="/detail-jobs/other">Other job</a><span>9 triệu</span><i>Nowhere</i><i>Intern</i><i>0 years</i></div></section>'
HEADER_PAGE = f"""'<html><body>' || CASE post_id % 5
  WHEN 0 THEN '{RELATED}<div class="hd"><div><div><a href="/detail-jobs/' || id || '?self"><b>' || t || '</b></a></div><span>10 triệu</span></div><div>' || c
    || '</div><div>Apply now</div><div>' || l || '</div><div>' || e || '</div><div>Your role</div><div>Nope</div></div>'
  WHEN 1 THEN '<header><h1>' || t || '</h1><p>Thoả thuận</p><p>' || c || '</p><p>' || l || '</p></header><p>Far away</p>'
  WHEN 2 THEN '<div><h1>' || t || '</h1><p>' || c || '</p></div>'
  WHEN 3 THEN '{RELATED}<article><a href="' || id || '">' || t || '</a><p>900 USD</p><p>' || t || '</p><p>' || c || '</p><p>' || l || '</p><p>' || e || '</p><p>Benefits</p><p>Nope</p></article>'
  ELSE '<div><p>5 triệu</p><p>' || c || '</p><p>' || l || '</p>{"<div>" * 12}<a href="/detail-jobs/' || id || '">' || t || '</a>{"</div>" * 12}</div>' END || '</body></html>'"""
HEADER_PARTS = """CAST(post_id AS VARCHAR(20)) AS id, 'Job ' || CAST(post_id % 70 AS VARCHAR(9)) AS t, 'City ' || CAST(post_id % 20 AS VARCHAR(9)) AS c,
  CASE post_id % 3 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Middle' ELSE 'Senior' END AS l, CAST(post_id % 9 AS VARCHAR(9)) || ' years' AS e"""


def header_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (raw_postings(spark, sf_dir).selectExpr("post_id", *_split(HEADER_PARTS))
            .select("post_id", F.concat(F.lit(f"{HOST}/detail-jobs/"), "id", F.lit("?x=1")).alias("url"), F.expr(HEADER_PAGE).alias("html")))


def _split(columns: str) -> list[str]:
    """'a AS x, b AS y' -> its columns (no comma stands inside one of them)."""
    return [c.strip() for c in columns.replace("VARCHAR(20)", "STRING").replace("VARCHAR(9)", "STRING").split(",")]
