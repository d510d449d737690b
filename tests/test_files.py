"""Readers and writers on small files in the usual layout."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cardwarden.plans import export, features, quality
from cardwarden.policy import RiskPolicy
from cardwarden.schemas import FRAUD_LABELS, TRANSACTIONS
from cardwarden.sources import files, publishing, shared, staging

TRANSACTIONS_CSV = """id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors
1,2010-01-01 00:01:00,10,100,$14.57,Swipe Transaction,7,Bulls Gap,TN,37711,5411,
2,2010-01-01 03:05:00,10,100,$-77.00,Chip Transaction,8,ONLINE,,,4829,Bad PIN
3,2010-01-02 12:00:00,11,101,"$1,200.50",Online Transaction,9,,,,9999,Insufficient Balance
4,,11,101,n/a,Swipe Transaction,9,Boise,ID,02134,,""
"""
CARDS_CSV = """id,client_id,card_brand,card_number,expires,cvv,has_chip,credit_limit,acct_open_date,year_pin_last_changed,card_on_dark_web
100,10,Visa,4344,12/2022,623,YES,$24295,09/2002,2008,No
101,11,Visa,4956,04/2020,393,NO,"$21,968",04/2014,2014,Yes
"""
USERS_CSV = """id,current_age,latitude,longitude,per_capita_income,yearly_income,total_debt,credit_score
10,53,34.15,-117.76,$29278,$59696,$127613,787
11,26,40.76,-73.74,$37891,$77254,$191349,701
"""
MCC_JSON = """{
  "5411": "Grocery Stores, Supermarkets",
  "4829": "Money Transfer",
  "x12": "non-numeric key, must not fail the join"
}
"""
LABELS_JSON = '{"target": {"1": "No", "2": "Yes",\n "3": "No"}}'


@pytest.fixture
def paths(tmp_path):
    folder = tmp_path / "sources"
    folder.mkdir()
    for name, text in (
        ("transactions_data.csv", TRANSACTIONS_CSV),
        ("cards_data.csv", CARDS_CSV),
        ("users_data.csv", USERS_CSV),
        ("mcc_codes.json", MCC_JSON),
        ("train_fraud_labels.json", LABELS_JSON),
    ):
        (folder / name).write_text(text)
    return files.SourcePaths.under(str(folder))


@pytest.fixture
def tables(spark, paths):
    return staging.open_sources(spark, paths)


def test_transactions_csv(spark, paths):
    rows = files.read_transactions(spark, paths.transactions)
    assert rows.schema.simpleString() == TRANSACTIONS.simpleString()
    one, two, three, four = rows.orderBy("id").collect()
    assert one["date"] == dt.datetime(2010, 1, 1, 0, 1) and one["errors"] is None
    assert (two["merchant_state"], two["zip"]) == (None, None)
    assert three["amount"] == "$1,200.50" and three["merchant_city"] is None
    assert (four["date"], four["mcc"], four["zip"], four["errors"]) == (None, None, "02134", None)


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "u.csv").write_text("credit_score,extra,id\n700,x,5\n")
    row = files.read_users(spark, str(tmp_path / "u.csv")).first()
    assert (row["id"], row["credit_score"], row["extra"], row["current_age"]) == (5, 700, "x", None)


def test_cards_and_users_csv(tables):
    cards = {r["id"]: r for r in tables.cards.collect()}
    assert (cards[100]["credit_limit"], cards[101]["credit_limit"]) == (24295.0, 21968.0)
    assert cards[101]["card_on_dark_web"] is True and cards[100]["has_chip"] is True
    assert cards[100]["expires"] == dt.date(2022, 12, 31)
    assert cards[100]["card_brand"] == "Visa"
    users = {r["id"]: r for r in tables.users.collect()}
    assert users[10]["yearly_income"] == 59696.0 and users[11]["credit_score"] == 701


def test_mcc_json(spark, paths):
    codes = {r["mcc"]: r["merchant_category"] for r in files.read_mcc_codes(spark, paths.mcc_codes).collect()}
    assert codes == json.loads(MCC_JSON)


@pytest.mark.parametrize(
    "text",
    [
        LABELS_JSON,
        '{"1":"No","2":"Yes","3":"No"}',
        '{\n  "1": "No",\n  "2": "Yes",\n  "3": "No"\n}\n',
        '{"1": "No"}\n{"2": "Yes"}\n{"3": "No"}\n',
    ],
)
def test_fraud_labels(spark, tmp_path, text):
    (tmp_path / "labels.json").write_text(text)
    labels = files.read_fraud_labels(spark, str(tmp_path / "labels.json"))
    assert labels.schema.simpleString() == FRAUD_LABELS.simpleString()
    assert sorted(map(tuple, labels.collect())) == [(1, False), (2, True), (3, False)]


def test_labels_of_any_spelling_are_kept(spark, tmp_path):
    (tmp_path / "labels.json").write_text(
        '{"1": "yes", "2": "NO", "3": 1, "4": "0", "5": "fraud", "6": "a, b", "99999999999999999999": "Yes"}'
    )
    got = files.read_fraud_labels(spark, str(tmp_path / "labels.json")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, True), (2, False), (3, True), (4, False), (5, None), (6, None), (None, True)], key=str
    )


def test_csv_files_of_differing_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,latitude,longitude\n1,10,20\n")
    (tmp_path / "b.csv").write_text("id,longitude,latitude\n2,20,10\n")
    with pytest.raises(Exception, match="header"):
        files.read_users(spark, str(tmp_path)).collect()


def test_large_label_document_is_read_in_pieces(spark, tmp_path):
    number = 20_000
    text = json.dumps({"target": {str(i): "Yes" if i % 7 == 0 else "No" for i in range(number)}})
    (tmp_path / "labels.json").write_text(text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        labels = files.read_fraud_labels(spark, str(tmp_path / "labels.json"))
        assert labels.rdd.getNumPartitions() > 5
        row = labels.agg(F.count("*"), F.countDistinct("transaction_id"), F.count_if("is_fraud")).first()
        assert tuple(row) == (number, number, -(-number // 7))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_json_document_with_schema(spark, tmp_path):
    (tmp_path / "d.json").write_text('[\n {"transaction_id": 1,\n "is_fraud": true},\n {"transaction_id": 2}\n]')
    rows = files.read_json_document(spark, str(tmp_path / "d.json"), FRAUD_LABELS).collect()
    assert sorted((r[0], r[1]) for r in rows) == [(1, True), (2, None)]


def test_null_counts_of_the_file(tables):
    nulls = {r["column_name"]: r["null_count"] for r in quality.null_counts(tables.tx).collect()}
    assert (nulls["errors"], nulls["zip"], nulls["date"], nulls["mcc"]) == (2, 2, 1, 1)


def test_staged_tables_equal_the_sources(spark, tables, tmp_path):
    staging.stage(tables, str(tmp_path / "staged"))
    again = staging.open_staged(spark, str(tmp_path / "staged"))
    for name, rows in vars(tables).items():
        saved = vars(again)[name]
        assert saved.schema.simpleString() == rows.schema.simpleString()
        assert sorted(map(repr, saved.collect())) == sorted(map(repr, rows.collect()))
    assert features.with_features(again.tx) is again.tx


def results_of(tables):
    return {"all": tables.tx.select("id", "card_id", "amount_num").orderBy("id")}


def test_export_writes_every_sink(spark, tables, tmp_path):
    folder = str(tmp_path / "out")
    enriched = features.enriched_transactions(tables.tx, tables.codes)
    for _ in range(2):  # the second run overwrites the first
        statuses = export.export_all(results_of(tables), enriched, folder, RiskPolicy(sample_rows=3))
    assert [(s.file_format, s.sink, s.rows) for s in statuses] == [
        ("parquet", "all", 4),
        ("parquet", "enriched_transactions", 4),
        ("csv", "all", 4),
        ("csv", "enriched_sample", 3),
    ]
    parts = list((tmp_path / "out" / "csv" / "all").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text().startswith("id,card_id,amount_num\n1,100,14.57")
    sample = spark.read.option("header", True).csv(f"{folder}/csv/enriched_sample")
    assert sorted(r["id"] for r in sample.collect()) == ["1", "2", "3"]
    saved = export.read_results(spark, folder, ["all", "enriched_transactions"])
    categories = {r["id"]: r["merchant_category"] for r in saved["enriched_transactions"].collect()}
    assert categories == {1: "Grocery Stores, Supermarkets", 2: "Money Transfer", 3: None, 4: None}


def test_a_failing_sink_does_not_stop_the_others(spark, tables, tmp_path):
    results = {
        "broken": tables.tx.select(F.raise_error(F.lit("no such thing")).alias("x")),
        **results_of(tables),
    }
    enriched = features.enriched_transactions(tables.tx, tables.codes)
    with pytest.raises(export.ExportError, match="broken") as raised:
        export.export_all(results, enriched, str(tmp_path / "out"))
    status = {(s.file_format, s.sink): s for s in raised.value.statuses}
    assert status["parquet", "broken"].error and status["csv", "broken"].error
    assert status["parquet", "all"].rows == 4 and status["csv", "enriched_sample"].rows == 4


def test_a_failing_sink_leaves_the_earlier_result(spark, tables, tmp_path):
    enriched, folder = features.enriched_transactions(tables.tx, tables.codes), str(tmp_path / "out")
    export.export_all(results_of(tables), enriched, folder, partition_by="tx_month")
    broken = {"all": tables.tx.select(F.raise_error(F.lit("no such thing")).alias("id"))}
    with pytest.raises(export.ExportError) as raised:
        export.export_all(broken, enriched, folder, partition_by="tx_month")
    rows = {(r["file_format"], r["sink"]): r for r in export.statuses_frame(spark, raised.value.statuses).collect()}
    assert "no such thing" in rows["parquet", "all"]["error"] and rows["parquet", "all"]["rows"] is None
    assert rows["csv", "enriched_sample"]["error"] is None and rows["csv", "enriched_sample"]["rows"] == 4
    assert sorted(export.read_results(spark, folder, ["all"])["all"].columns) == ["amount_num", "card_id", "id"]
    assert export.read_results(spark, folder, ["all"])["all"].count() == 4
    assert spark.read.option("header", True).csv(f"{folder}/csv/all").count() == 4
    assert sorted(p.name for p in (tmp_path / "out" / "parquet").iterdir()) == ["all", "enriched_transactions"]


def test_a_run_that_ended_while_publishing_is_mended(spark, tmp_path):
    path = tmp_path / "t"
    export.write_parquet(spark.range(3), str(path))
    path.rename(tmp_path / ".t.earlier-0")
    with pytest.raises(RuntimeError):
        publishing.published(spark, str(path), lambda _: (_ for _ in ()).throw(RuntimeError()))
    assert spark.read.parquet(str(path)).count() == 3
    export.write_parquet(spark.range(5), str(path))
    assert spark.read.parquet(str(path)).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_months_are_read_and_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "by_month")
    rows = spark.range(120).select("id", (F.col("id") % 12 + 1).cast("int").alias("tx_month"))
    export.replace_partitions(rows, path, "tx_month")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "by_month").glob("tx_month=*/part-*")}
    saved = spark.read.parquet(path)
    export.replace_partitions(saved.filter("tx_month = 3").filter("id < 50"), path, "tx_month")
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "by_month").glob("tx_month=*/part-*")}
    assert {p.parent.name for p, _ in set(before.items()) ^ set(now.items())} == {"tx_month=3"}
    counts = dict(map(tuple, spark.read.parquet(path).groupBy("tx_month").count().collect()))
    assert counts == {m: 4 if m == 3 else 10 for m in range(1, 13)}
    one = spark.read.parquet(path).filter("tx_month = 3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tx_month" in plan and one.count() == 4


def test_csv_results_keep_their_partitions_unless_named(spark, tables, tmp_path):
    results = {"large": tables.tx.select("id").repartition(2, "id"), "small": spark.range(3, numPartitions=2)}
    enriched = features.enriched_transactions(tables.tx, tables.codes)
    export.export_all(results, enriched, str(tmp_path / "out"), single_file=frozenset({"small"}))
    files_of = {n: len(list((tmp_path / "out" / "csv" / n).glob("part-*"))) for n in results}
    assert files_of["small"] == 1 and files_of["large"] == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "csv" / "large")).count() == 4


def test_partitioned_parquet(spark, tables, tmp_path):
    path = str(tmp_path / "by_month")
    export.write_parquet(tables.tx, path, "tx_month")
    assert sorted(p.name for p in (tmp_path / "by_month").glob("tx_month=*")) == [
        "tx_month=1", "tx_month=__HIVE_DEFAULT_PARTITION__"
    ]
    assert spark.read.parquet(path).count() == 4


def test_export_by_month(spark, tables, tmp_path):
    enriched = features.enriched_transactions(tables.tx, tables.codes)
    out = str(tmp_path / "out")
    statuses = export.export_all({}, enriched, out, RiskPolicy(sample_rows=2), "tx_month")
    assert [s.rows for s in statuses] == [4, 2]
    assert (tmp_path / "out" / "parquet" / "enriched_transactions" / "tx_month=1").is_dir()
    sample = files.read_csv(spark, f"{out}/csv/enriched_sample", TRANSACTIONS)
    assert sorted((r["id"], r["date"]) for r in sample.collect()) == [
        (1, dt.datetime(2010, 1, 1, 0, 1)), (2, dt.datetime(2010, 1, 1, 3, 5))
    ]


def test_shared_folder_needs_a_setting_on_a_cluster(spark):
    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(name, default):
            return default

    class Cluster:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Cluster, "x")


def test_shared_table(spark):
    rows = shared.shared_table(spark.range(5), "t")
    assert rows.count() == 5


def test_whole_run(spark, paths, tmp_path):
    from cardwarden import report

    out = str(tmp_path / "out")
    places = spark.createDataFrame(
        [("Bulls Gap", 36.3, -83.1)], "merchant_city string, latitude double, longitude double"
    )
    policy = RiskPolicy(min_tx_card_rate=1, min_tx_client_rate=1)
    results = report.run(spark, paths, out, policy, places)
    assert results["impossible_travel"].count() == 0
    assert {r["error_rate"] for r in results["client_context"].collect()} == {50.0}
    for name, rows in results.items():
        assert rows.count() >= 0, name
    assert results["summary"].first()["scored_cards"] == 2
    assert [r["column_name"] for r in results["null_counts"].collect()] == TRANSACTIONS.fieldNames()
    quality_of_cut = {r["risk_level"]: r for r in results["fraud_label_eval"].collect()}
    assert quality_of_cut["NORMAL"]["true_positive"] == 1
    assert export.read_results(spark, out, ["card_risk_scores"])["card_risk_scores"].count() == 2
