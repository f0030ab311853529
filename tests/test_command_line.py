"""The command line, end to end."""

from ledgersieve.__main__ import main


def test_generate_start_and_inspect(spark, tmp_path, capsys):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    main(["generate", "--rows", "200", "--out", source, "--invalid-rate", "0.5"], spark)
    main(["start", "--input", source, "--output", out, "--partitions", "2"], spark)
    run_id = capsys.readouterr().out.split()[-1]
    main(["start", "--input", source, "--output", out, "--max-files", "3"], spark)
    assert capsys.readouterr().out.split()[-1] == "COMPLETED"
    main(["status", "--output", out], spark)
    assert capsys.readouterr().out.count("COMPLETED") == 2
    main(["status", "--output", out, "--run", run_id], spark)
    assert "partition-1" in capsys.readouterr().out
    main(["summary", "--output", out], spark)
    shown = capsys.readouterr().out
    assert "\t\t400\n" in shown and "bank_code" in shown
