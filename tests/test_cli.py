"""The command line end to end: generate → build → incremental → test → report."""

import os

import pytest

from fraudlens.__main__ import main


@pytest.mark.usefixtures("spark")
def test_cli_workflow(tmp_dir, capsys):
    raw, marts = f"{tmp_dir}/raw", f"{tmp_dir}/marts"
    assert main(["generate", "--out", raw, "--rows", "3000", "--customers", "200", "--merchants", "30",
                 "--cards", "300"]) == 0
    landed = f"{tmp_dir}/landed"
    assert main(["load", "--csv", raw, "--raw", landed]) == 0
    assert main(["--input-bytes", "1000000", "build", "--raw", landed, "--out", marts, "--as-of", "2024-12-31"]) == 0
    assert main(["incremental", "--raw", landed, "--out", marts,
                 "--as-of", "2024-12-31"]) == 0
    code = main(["test", "--raw", landed, "--out", marts, "--as-of", "2024-12-31", "--at", "2024-12-31 12:00:00"])
    out = capsys.readouterr().out
    assert sum(out.count(s) for s in ("PASS", "WARN", "FAIL")) == 60
    assert len(os.listdir(f"{marts}/quality_results")) > 0          # results persisted
    # generated data has no dangling keys and clean codes: only the synthetic 'UNKNOWN'-free checks run
    assert code == 0, out
    assert main(["report", "--marts", marts, "--name", "r2", "--out", f"{tmp_dir}/r2"]) == 0
    assert any(f.endswith(".csv") for f in os.listdir(f"{tmp_dir}/r2"))
    assert main(["freshness", "--raw", landed, "--at", "2030-01-01 00:00:00"]) == 1   # stale: error
    assert "\"freshness_status\": \"error\"" in capsys.readouterr().out
