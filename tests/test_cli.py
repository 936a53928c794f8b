"""The command line runs the medallion steps as separate processes."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "starforge", *args, "--master", "local[2]"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return [json.loads(line) for line in out.stdout.splitlines() if line.startswith("{")]


def test_cli_steps(tmp_path, sf_small):
    lake = str(tmp_path / "lake")
    assert _run("land", "--sf", sf_small, "--root", lake) == []
    silver = _run("silver", "--root", lake, "historico", "clientes", "tickets", "contratacoes")
    assert {r["step"] for r in silver} == {"silver:historico", "silver:clientes",
                                           "silver:tickets", "silver:contratacoes"}
    gold = _run("gold", "--root", lake, "dim_tempo", "dim_cliente", "dim_produto",
                "fato_contratacoes")
    rows = {r["step"]: r["rows"] for r in gold}
    assert rows["gold:fato_contratacoes"] > 0 and rows["gold:dim_cliente"] > 0
