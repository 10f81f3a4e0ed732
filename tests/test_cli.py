import json

from vantage.__main__ import main
from vantage.plans.builder import InsightBuilder
from tests.conftest import SF_SMALL


def test_cli_insight_to_parquet(spark, tmp_path, capsys):
    spec = (InsightBuilder().add_dataset("orders").add_select("o_orderstatus")
            .add_select("o_orderkey", aggregate="count", label="n").build())
    spec_file = tmp_path / "spec.json"
    spec_file.write_text(json.dumps(spec))
    out = str(tmp_path / "out")
    assert main(["insight", str(spec_file), "--dataset", f"orders={SF_SMALL}/orders.parquet", "--out", out],
                spark=spark) == 0
    got = {r.o_orderstatus: r.n for r in spark.read.parquet(out).collect()}
    assert sum(got.values()) == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


def test_cli_sql_prints_rows(spark, capsys):
    main(["sql", "SELECT count(*) AS n FROM '{{o}}' WHERE o_orderstatus = :s",
          "--dataset", f"o={SF_SMALL}/orders.parquet", "--named", "s=F"], spark=spark)
    printed = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert printed and printed[0]["n"] > 0


def test_cli_sql_over_a_dataset_store(spark, tmp_path, capsys):
    from vantage.sources.datasets import DatasetStore

    store = DatasetStore(spark, str(tmp_path / "store"))
    store.write("orders", spark.read.parquet(f"{SF_SMALL}/orders.parquet"))
    out = str(tmp_path / "out")
    main(["sql", "SELECT o_orderstatus, count(*) AS n FROM '{{orders}}' GROUP BY o_orderstatus",
          "--store", str(tmp_path / "store"), "--out", out], spark=spark)
    assert spark.read.parquet(out).count() == 3
