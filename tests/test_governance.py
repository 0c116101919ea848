import hashlib

from pyspark.sql import functions as F

from brassledger import fixtures as X
from brassledger.operators import governance as G


def people(spark):
    rows = [("C1", "MD"), ("C2", "CA"), ("C3", None), (None, "VA")]
    return spark.createDataFrame(rows, "customer_id string, state string")


def test_identifier_mask(spark):
    shown = people(spark).select(G.mask_identifier("customer_id", G.ANALYST).alias("m")).collect()
    want = "H_" + hashlib.sha256(b"C1").hexdigest()[:16]
    assert shown[0]["m"] == want and shown[3]["m"] is None
    for role in (G.STEWARD, G.ENGINEER, G.ADMIN):
        assert people(spark).select(G.mask_identifier("customer_id", role).alias("m")).first()["m"] == "C1"


def test_balance_mask(spark):
    df = spark.createDataFrame([("1499.99",), ("-1500.00",), ("499.99",)], "b string").select(F.col("b").cast("decimal(18,2)"))
    assert [str(r["b"]) for r in df.select(G.mask_balance("b", G.ANALYST).alias("b")).collect()] == ["1000.00", "-2000.00", "0.00"]


def test_row_access(spark):
    df = people(spark)
    assert G.visible_rows(df, G.ANALYST).count() == 4
    assert sorted(r["state"] for r in G.visible_rows(df, G.REGIONAL).collect()) == ["MD", "VA"]
    assert G.visible_rows(df, "SOMEONE_ELSE").count() == 0


def test_both_forms_of_the_policy_agree(spark, small_dir):
    customers = X.run(spark, small_dir).dim_customer
    roles = [G.ENGINEER, G.ANALYST, G.REGIONAL, "SOMEONE_ELSE"]
    seen = G.visible_per_role(customers, roles, G.entitlements(spark)).groupBy("role_name").agg(F.sum("customers").alias("n"))
    counts = {r["role_name"]: r["n"] for r in seen.collect()}
    assert counts == {r: n for r in roles if (n := G.visible_rows(customers, r).count())}


def test_masking_keeps_names_types_and_order(spark, small_dir):
    fact = X.run(spark, small_dir).fact
    for role in (G.ANALYST, G.STEWARD):
        assert G.apply_masking(fact, "fact_transactions", role).dtypes == fact.dtypes


def test_tags_travel(spark):
    tagged = G.tag_columns(people(spark), "dim_customer").select("state").filter("state is not null")
    assert tagged.schema["state"].metadata[G.CLASSIFICATION] == "QUASI_IDENTIFIER"
    assert "Data Office" in tagged.schema["state"].metadata["data_owner"]
    described = G.describe_columns(tagged, {"state": "US state"})
    assert described.schema["state"].metadata[G.COMMENT] == "US state"
