"""The ``raw_postings`` fixture: two job feeds derived from orders x customer.

The SQL text is shared verbatim by Spark and by the DuckDB oracle, so both
engines start from identical rows.  It is a plain equi join plus per-row
expressions, so in Spark it is one shuffle (or a runtime broadcast of the
customer side when AQE measures it small) and scales with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import spread, table

RAW_POSTINGS_SQL = """
SELECT o.o_orderkey AS post_id,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'feed_a' ELSE 'feed_b' END AS source,
       CASE o.o_orderkey % 13
         WHEN 0 THEN 'Senior Python Developer' WHEN 1 THEN 'Java Backend Engineer'
         WHEN 2 THEN 'Javascript Frontend Dev' WHEN 3 THEN 'DevOps Engineer (AWS)'
         WHEN 4 THEN 'Data Engineer' WHEN 5 THEN 'QA Automation Tester'
         WHEN 6 THEN 'Kế toán trưởng' WHEN 7 THEN 'Fullstack React/NodeJS'
         WHEN 8 THEN 'Mobile iOS Developer' WHEN 9 THEN 'Security Analyst'
         WHEN 10 THEN 'Nhân viên kinh doanh' WHEN 11 THEN 'Cloud Architect' ELSE '' END AS title,
       CASE WHEN o.o_orderkey % 97 = 0 THEN '' ELSE c.c_name END AS company,
       CASE o.o_custkey % 12
         WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Hồ Chí Minh: Quận 1' WHEN 2 THEN 'HCMC' WHEN 3 THEN 'Đà Nẵng'
         WHEN 4 THEN 'ha noi & ho chi minh' WHEN 5 THEN 'Cần Thơ' WHEN 6 THEN 'Bình Dương'
         WHEN 7 THEN 'vũng tàu' WHEN 8 THEN '15 - 20 triệu' WHEN 9 THEN '' WHEN 10 THEN NULL
         ELSE 'Dong Nai' END AS city_raw,
       CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 41 = 0 THEN CAST(0 AS DOUBLE)
            ELSE o.o_totalprice * 100 END AS salary_min,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
            ELSE o.o_totalprice * 100 * (1 + CAST(o.o_orderkey % 4 AS DOUBLE) / 10) END AS salary_max,
       CASE o.o_orderkey % 9
         WHEN 0 THEN '12 - 17 triệu' WHEN 1 THEN 'Tới 20 triệu' WHEN 2 THEN 'Trên 15 triệu'
         WHEN 3 THEN 'Thoả thuận' WHEN 4 THEN '40.000.000 - 60.000.000 VND' WHEN 5 THEN 'Up to 1,500 USD'
         WHEN 6 THEN '12,5 triệu' WHEN 7 THEN '500k' ELSE '' END AS salary_raw,
       CASE o.o_orderkey % 11
         WHEN 0 THEN 'Fresher' WHEN 1 THEN '1 - 3 năm' WHEN 2 THEN '5 năm' WHEN 3 THEN 'Senior'
         WHEN 4 THEN 'Junior, Middle' WHEN 5 THEN '2.5 years' WHEN 6 THEN 'International team'
         WHEN 7 THEN 'Không yêu cầu' WHEN 8 THEN '' WHEN 9 THEN NULL ELSE 'Trên 10 năm' END AS exp_raw,
       CASE o.o_orderkey % 10
         WHEN 0 THEN 'Python, Django, SQL and Docker on AWS' WHEN 1 THEN 'Java 8, Spring Boot, MySQL; git flow'
         WHEN 2 THEN 'ReactJS + NodeJS, HTML5/CSS3' WHEN 3 THEN 'AWS Docker Kubernetes (k8s) Terraform Jenkins'
         WHEN 4 THEN 'Python pandas numpy scikit-learn TensorFlow' WHEN 5 THEN 'C++ / C# / .NET lập trình nhúng'
         WHEN 6 THEN 'Chăm sóc khách hàng' WHEN 7 THEN 'pythn typo, kubernets, golang' WHEN 8 THEN NULL
         ELSE 'React Native, Swift, Kotlin, Flutter' END AS job_description,
       CASE o.o_custkey % 6
         WHEN 0 THEN 'Remote work, English IELTS 6.5' WHEN 1 THEN 'Work from home' WHEN 2 THEN 'TOEIC 700'
         WHEN 3 THEN 'postgres, redis cache, linux bash' WHEN 4 THEN '' ELSE 'git, jira, SQL server, python' END AS qualifications,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'Fulltime' WHEN 1 THEN 'hybrid ' WHEN 2 THEN '' ELSE 'Parttime' END AS working_form,
       'https://jobs.example.com/viec-lam/' || CAST(o.o_orderkey % 5000 AS VARCHAR(20)) || '.html?ta_source=x&page=2' AS source_url
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds in one table (``source`` = feed_a / feed_b), raw layer."""
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # the shared SQL text, with the two tables bound as DataFrame parameters
    text = RAW_POSTINGS_SQL.replace("FROM orders o JOIN customer c", "FROM {orders} o JOIN {customer} c")
    return spark.sql(text, orders=orders, customer=customer)
