"""The command line front end."""

import os

from terrace.__main__ import main

SF = "/root/testdata/sf0.001"


def test_list_prints_every_key(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "gold_fct_orders" in out and len(out) == 169


def test_run_writes_the_model(spark, tmp_dir, capsys):
    if not os.path.isdir(SF):
        return
    out = os.path.join(tmp_dir, "q08")
    assert main(["run", "q08_payment_usage", "--data", SF, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 4
