from medallion.__main__ import main
from tests import landing_fixtures as lf


def test_cli_run_then_layer_and_test(spark, tmp_path, capsys):
    raw, wh = str(tmp_path / "raw"), str(tmp_path / "wh")
    lf.land_first_batch(raw)
    main(["run", "--landing", raw, "--warehouse", wh, "--countries", "80,110", "--no-archive"])
    out = capsys.readouterr().out
    assert '"test": "duplicates", "failures": 1' in out
    main(["layer", "silver", "--landing", raw, "--warehouse", wh])
    assert '"silver_measurement": "skip"' in capsys.readouterr().out
    main(["archive", "--landing", raw, "--warehouse", wh])
    assert '"measurement": 1' in capsys.readouterr().out
