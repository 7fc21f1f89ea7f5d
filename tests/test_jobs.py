from __future__ import annotations

import json
import os

from tessera.plans import jobs
from tessera.plans.finances_csv import FIN_NAMES, FIN_SCHEMA
from tests.test_sources_sinks import BAD_CSV


def test_company_tiers(spark, tmp_dir):
    p = os.path.join(tmp_dir, "company.json")
    with open(p, "w") as fh:
        for company, names in [("FamilyCo", ["Ann", "Bob"]), ("OldCo", ["Cid"]), ("NewCo", []), ("X", ["Dee"])]:
            fh.write(json.dumps({"company": company, "employees": [{"firstName": n} for n in names]}) + "\n")
    companies = spark.read.json(p)
    out = jobs.company_tiers(companies, {"FamilyCo": "Premium", "OldCo": "Legacy"})
    tiers = sorted(tuple(r) for r in out["tiered"].collect())
    assert tiers == [("FamilyCo", "Ann", "Premium"), ("FamilyCo", "Bob", "Premium"), ("OldCo", "Cid", "Legacy"),
                     ("X", "Dee", "Standard")]
    positions = sorted((r.company, r.employeePosition) for r in out["positioned"].collect())
    assert positions == [("FamilyCo", 0), ("FamilyCo", 1), ("OldCo", 0), ("X", 0)]


def test_people_cleaning(people_df):
    out = jobs.people_cleaning(people_df, order=["age"], needle="keeper", listed=["Beekeeper", "Surveyor"])
    assert out["matching"].count() == 2
    assert out["listed"].count() == 3
    assert [r.fullName for r in out["not_listed"].collect()] == ["Ula Brandt"]
    assert sorted((r.firstName, r.weightInLbs) for r in out["clean"].collect()) == [
        ("Nadia", 0.0), ("Timo", 0.0), ("Timo", 101.2), ("Ula", 0.0), ("Ula", 64.5), ("Ula", 88.0),
    ]
    assert {r.name_key: r.first_weight for r in out["first"].collect()} == {"ula": None, "timo": None, "nadia": None}
    assert {r.name_key: r.first_weight for r in out["first_non_null"].collect()} == {"ula": 64.5, "timo": 101.2, "nadia": None}


def test_product_ranking_both_plans(products_df):
    a = jobs.product_ranking(products_df, strategy="window")
    b = jobs.product_ranking(products_df, strategy="split", max_rows_per_key=1)
    cols = ["product", "prevRevenue", "prev2Revenue", "row_number", "rev_rank", "rev_dense_rank"]
    assert sorted(tuple(r) for r in a.select(*cols).collect()) == sorted(tuple(r) for r in b.select(*cols).collect())


def test_csv_to_orc_ranking_and_reload(spark, tmp_dir):
    p = os.path.join(tmp_dir, "fin.csv")
    with open(p, "w") as fh:
        fh.write(BAD_CSV)
    out = jobs.csv_to_format_ranking(p, FIN_SCHEMA, os.path.join(tmp_dir, "orc"), "orc", spark=spark)
    assert sorted(r.id for r in out["filtered"].collect()) == sorted(r.id for r in out["csv_filtered"].collect())
    assert out["ranked"].count() == 4
    m11 = jobs.csv_load_repartition(spark, p, FIN_SCHEMA, FIN_NAMES, os.path.join(tmp_dir, "fin_out"))
    assert m11["permissive"].count() == 4 and m11["strict"].count() == 1 and m11["reread"].count() == 1


def test_document_store(spark, tmp_dir):
    students = spark.createDataFrame([("A", "R", "ITER", 200), ("S", "R", None, 100)],
                                     "firstname string, lastname string, school string, studentno int")
    back = jobs.document_store(students, os.path.join(tmp_dir, "students"), students.schema)
    assert sorted((r.studentno, r.school) for r in back.collect()) == [(100, None), (200, "ITER")]


def test_account_report_and_rolling_accounts(spark):
    from pyspark.sql import functions as F

    from tessera.plans.standins import finances
    from tests.conftest import SF_SMALL

    fin = finances(spark, SF_SMALL)
    rep = jobs.account_report(fin, movies_label="1-URGENT")
    top = [tuple(r) for r in fin.orderBy(F.col("Amount").desc(), "TxnId").limit(5).select("TxnId", "Amount").collect()]
    assert [(r.TxnId, r.Amount) for r in rep["top5"].collect()] == top
    assert rep["summary"].count() == fin.select("AccountNumber").distinct().count()
    assert set(rep["arrays"].columns) >= {"CountOfUniqueTransactionTypes", "WentToMovies"}
    raw = fin.withColumn("Date", F.date_format("Date", "M/d/yyyy"))
    rolled = jobs.rolling_accounts(raw)
    assert rolled.count() == fin.count()
    assert rolled.filter(F.col("RollingAvg").isNull()).count() == 0


def test_order_charge_profile_and_layout(spark, tmp_dir):
    from pyspark.sql import functions as F

    from tessera.plans.charges import order_charges
    from tests.conftest import SF_SMALL

    charges = order_charges(spark, SF_SMALL).withColumn("OMOID", F.col("l_orderkey"))
    out = jobs.order_charge_profile(charges, os.path.join(tmp_dir, "daily"))
    assert out["count"].first()[0] == charges.count()
    assert out["frequency"].count() == 3
    assert out["zips"].count() == charges.select("Boro", "Zip").distinct().count()
    assert out["daily_distinct"].agg({"OMODailyFreq": "sum"}).first()[0] == charges.count()
    assert spark.read.parquet(os.path.join(tmp_dir, "daily")).count() == charges.count()
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    laid = jobs.year_layout(orders, "o_orderdate", os.path.join(tmp_dir, "years"))
    assert laid.count() == orders.count() and "OrderYear" in laid.columns


def test_transaction_load_and_scholarship(spark, tmp_dir):
    from tessera.plans import standins
    from tessera.plans.transactions import stage_transaction_text
    from tessera.sources.files import read_text_fields
    from tests.conftest import SF_SMALL

    fields = read_text_fields(spark, stage_transaction_text(spark, SF_SMALL), delimiter="|", header_prefix="txn_id")
    out = jobs.transaction_load(fields)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert out["count"].first()[0] == n
    audit = out["audit"].first()
    assert (audit.total, audit.good) == (n, n) and out["rejects"].count() == 0
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").groupBy("l_suppkey").sum("l_extendedprice").collect()
    totals = {r.merchant_id: r.total_amount for r in out["totals"].collect()}
    assert all(abs(totals[r[0]] - r[1]) < 1e-6 * r[1] for r in li)
    assert out["totals"].count() == out["merchants"].first()[0]
    sch = jobs.scholarship_recipients(
        standins.demographics(spark, SF_SMALL), standins.finance_flags(spark, SF_SMALL),
        standins.courses(spark, SF_SMALL), standins.SWITZERLAND,
    )
    assert sch["with_course"].count() == sch["recipients"].count()
