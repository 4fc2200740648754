"""The command-line job: run, report, gate over the published tables."""

import json
import tempfile

from opslake.__main__ import main


def test_cli_run_report_gate(spark, capsys):
    root = tempfile.mkdtemp(prefix="opslake-cli-")
    assert main(["--root", root, "run", "--tables", "/root/testdata/sf0.001"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"]["gold.obt_flights"] == out["rows"]["gold.fact_flights"] > 0
    assert out["contract"]["quarantined"] == out["rows"]["silver.vra_quarentena"]
    assert main(["--root", root, "report", "punctuality_by_airline", "--rows", "3"]) == 0
    assert "dep_on_time_pct" in capsys.readouterr().out
    assert main(["--root", root, "report", "quality_summary"]) == 0
    assert main(["--root", root, "gate"]) == 0
    assert "bronze_not_empty" in capsys.readouterr().out
    assert main(["--root", root, "report", "no_such_report"]) == 2
