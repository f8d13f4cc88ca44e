"""Detail pages around the postings' fields: the input of the page queries.

The SQL text is shared by Spark and the DuckDB oracle, so both start from the
same pages; they vary with the posting (which fields a page has, how it labels
them, where its title stands)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.postings import raw_postings

POSTING_PAGES_SQL = """
SELECT post_id, source_url AS url,
  '<html><head><title>' || title || ' | IT jobs</title><style>p, b</style></head><body><nav><a href="/it-jobs">Jobs</a></nav>'
  || CASE WHEN post_id % 5 = 0 THEN '<a class=self href="/viec-lam/' || CAST(post_id % 5000 AS VARCHAR(20)) || '.html?from=card"><b>Role</b> ' || title || '</a>'
          ELSE '<h1 class="name">' || title || '</h1>' END
  || '<div class="pay"><span>' || CASE WHEN coalesce(salary_raw, '') = '' THEN 'Negotiable' ELSE salary_raw END || '</span></div>'
  || '<div>' || coalesce(city_raw, 'Anywhere') || '</div><div>Apply now</div><div>'
  || CASE post_id % 3 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Middle' ELSE 'Senior' END || '</div><div>'
  || CASE WHEN coalesce(exp_raw, '') = '' THEN '1 year' ELSE exp_raw END || '</div><h2>'
  || CASE post_id % 2 WHEN 0 THEN 'Your role &amp; responsibilities' ELSE 'Mô tả công việc' END || '</h2><p>'
  || coalesce(job_description, 'To be told') || '</p><h3 class="s">Your skills</h3><ul><li>' || qualifications || '</li><li>Team work</li></ul>'
  || CASE WHEN post_id % 4 = 0 THEN '' ELSE '<b>Benefits</b><br>Laptop<br>Month ' || CAST(post_id % 9 AS VARCHAR(4)) END
  || '<div class="co"><p>' || company || CASE post_id % 3 WHEN 0 THEN ' Company' WHEN 1 THEN ' JSC' ELSE ' Studio' END || '</p>'
  || CASE post_id % 3 WHEN 0 THEN '<p>Industry: Software ' || CAST(post_id % 4 AS VARCHAR(2)) || '</p>'
                      WHEN 1 THEN '<div>Industry</div><div>Fintech</div>' ELSE '' END
  || CASE post_id % 4 WHEN 0 THEN '<p>Company size: 100-499 people</p>' WHEN 1 THEN '<p>about 50 - 99 employees</p>' ELSE '' END
  || CASE post_id % 3 WHEN 2 THEN '<p>Working location</p><p>Tower ' || CAST(post_id % 20 AS VARCHAR(3)) || '</p>' ELSE '' END
  || '<div>' || working_form || '</div><p>View company</p></div><footer>&copy; jobs</footer></body></html>' AS html
FROM raw"""


def posting_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(POSTING_PAGES_SQL.replace("FROM raw", "FROM {raw}"), raw=raw_postings(spark, sf_dir))
