"""The record-file jobs and the command line, on hand-made files."""

from tests.test_operators import ORDERS, PAYS, RECEIPTS, write_csv
from tidemark.__main__ import main
from tidemark.plans import files


def test_file_jobs(spark, tmp_path):
    orders = write_csv(tmp_path, "orders.csv", ORDERS)
    states = {r.order_id: r.result_state for r in files.order_timeout(spark, orders).collect()}
    assert states[3] == "timeout" and states[6] == "payed but already timeout"
    pays, rec = write_csv(tmp_path, "p.csv", PAYS), write_csv(tmp_path, "r.csv", RECEIPTS)
    assert files.tx_match(spark, pays, rec, "join").count() == 4


def test_cli_writes_result(spark, tmp_path, capsys):
    orders = write_csv(tmp_path, "orders.csv", ORDERS)
    out = str(tmp_path / "out")
    assert main(["order-timeout", "--orders", orders, "--method", "pattern", "--out", out]) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got[0] == (1, "payed") and len(got) == 5
    assert main(["list"]) == 0 and "tx-match" in capsys.readouterr().out
