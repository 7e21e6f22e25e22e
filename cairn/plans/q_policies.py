"""Registered governance queries (G1-G3, G5) on customers with derived
contact columns, and on the enriched documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import scalars
from cairn.operators import policies as pol
from cairn.operators import text as tx
from cairn.plans.registry import register
from cairn.session import read_table

# fixed values: the roles of the source policies
ADMIN_ROLES = ("ACCOUNTADMIN", "PII_ADMIN")
EMAIL_MASK = pol.MaskingPolicy(scalars.mask_email_greedy, ADMIN_ROLES)
PHONE_MASK = pol.MaskingPolicy(scalars.mask_phone, ADMIN_ROLES)
REGION_POLICY = pol.RowAccessPolicy(ADMIN_ROLES, {"SUPPORT": lambda: F.col("region") == "AMERICA"})


def customers_pii(spark, root):
    """customer_id, name, email, phone (tagged pii_class = PHONE), region."""
    c = read_table(spark, root, "customer")
    n = F.broadcast(read_table(spark, root, "nation"))   # fixed 25 rows
    r = F.broadcast(read_table(spark, root, "region"))   # fixed 5 rows
    df = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                   scalars.demo_email(F.col("c_name"), F.col("c_custkey")).alias("email"),
                   F.concat(F.lit("555-"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"))
                   .alias("phone"),
                   F.col("r_name").alias("region")))
    return pol.set_tag(df, "phone", "pii_class", "PHONE")


_PII = """
WITH pii AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@shop' || CAST(c_custkey % 3 AS VARCHAR) || '.com' AS email,
         '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def _view(spark, root, role, rows=True):
    return pol.apply_policies(customers_pii(spark, root), role, masks={"email": EMAIL_MASK},
                              row_policy=REGION_POLICY if rows else None,
                              tag_masks={"pii_class": PHONE_MASK})


@register("mask_email_support", oracle=_PII + """
SELECT customer_id, name, regexp_replace(email, '.+@', '****@') AS email, '***-****' AS phone, region FROM pii""")
def mask_email_support(spark, root):
    """G1: the SUPPORT role sees masked e-mail and phone (no row policy)."""
    return _view(spark, root, "SUPPORT", rows=False)


@register("mask_email_admin", oracle=_PII + "SELECT * FROM pii")
def mask_email_admin(spark, root):
    """G1: an exempt role sees the real values and every row."""
    return _view(spark, root, "PII_ADMIN")


@register("row_access_support", oracle=_PII + """
SELECT customer_id, name, regexp_replace(email, '.+@', '****@') AS email, '***-****' AS phone, region
FROM pii WHERE region = 'AMERICA'""")
def row_access_support(spark, root):
    """SUPPORT keeps only its region's rows, masked."""
    return _view(spark, root, "SUPPORT")


@register("row_access_denied", oracle=_PII + "SELECT * FROM pii WHERE false")
def row_access_denied(spark, root):
    """A role the policy does not name sees no row (default deny)."""
    return _view(spark, root, "ANALYST")


@register("mask_by_tag", oracle=_PII + """
SELECT customer_id, '***-****' AS phone FROM pii""")
def mask_by_tag(spark, root):
    """The phone column is masked because it carries the pii_class tag
    whose policy masks it (no policy named on the column itself)."""
    df = customers_pii(spark, root).select("customer_id", "phone")
    return pol.apply_policies(df, "SUPPORT", tag_masks={"pii_class": PHONE_MASK})


_SERVICE = r"""
SELECT doc_id AS ticket_id, source AS channel, lang,
       regexp_replace(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+')[1],
                      '^[^@]+', '****') AS customer_email,
       sentiment_score,
       CASE WHEN sentiment_score < -0.3 THEN 'HIGH' WHEN sentiment_score < 0.3 THEN 'MEDIUM'
            ELSE 'LOW' END AS priority, category, summary
FROM scores JOIN category USING (doc_id) LEFT JOIN gist USING (doc_id)"""


def _sentiment_oracle():
    from cairn.plans.q_text import _SENTIMENT, _SUMMARY, _labels_sql
    scores = _SENTIMENT.replace("SELECT d.doc_id, d.lang, d.text,", "SELECT d.doc_id, d.lang, d.text, d.source,")
    return scores.rstrip() + "," + _labels_sql("category", tx.CATEGORIES, list(tx.CATEGORIES)[-1]) + f", gist AS ({_SUMMARY})"


@register("tickets_service", oracle=_sentiment_oracle() + _SERVICE)
def tickets_service(spark, root):
    """Governed serving view: shaped columns, priority from sentiment, the
    one-line summary, e-mail masked (local part) for non-exempt roles."""
    d = read_table(spark, root, "documents")
    scored = tx.with_label(tx.with_sentiment(tx.with_tokens(d, "text"), "_tok"), "_tok", tx.CATEGORIES, "category")
    shaped = scored.select(
        F.col("doc_id").alias("ticket_id"), F.col("source").alias("channel"), "lang",
        tx.first_answer(F.col("text"), "email").alias("customer_email"), "sentiment_score", "category")
    gist = tx.summarize(d).select(F.col("doc_id").alias("_of"), "summary")
    shaped = shaped.join(gist, F.col("ticket_id") == F.col("_of"), "left").drop("_of")
    shaped = shaped.withColumn("priority", scalars.priority_band(F.col("sentiment_score")))
    mask = pol.MaskingPolicy(scalars.mask_email_local, ("ACCOUNTADMIN",))
    return pol.apply_policies(shaped, "CAPSTONE_ANALYST", masks={"customer_email": mask})
