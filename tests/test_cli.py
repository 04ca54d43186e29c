from tidewatch.cli import main


def test_cli_reconcile_to_parquet(spark, tmp_path):
    orders = tmp_path / "orders.csv"
    orders.write_text("501,create,,1700000042\n501,pay,tx-501,1700000044\n"
                      "502,pay,tx-502,1700000045\n")
    receipts = tmp_path / "receipts.csv"
    receipts.write_text("tx-501,wechat,1700000047\ntx-777,wechat,1700000045\n")
    out = tmp_path / "out"
    main(["tx_reconcile", "--input", str(orders), "--receipts", str(receipts), "--out", str(out)])
    got = sorted((r.tx_id, r.outcome) for r in spark.read.parquet(str(out)).collect())
    assert got == [("tx-501", "matched"), ("tx-502", "order_only"), ("tx-777", "receipt_only")]


def test_cli_permissive_skips_bad_lines(spark, tmp_path):
    logins = tmp_path / "logins.csv"
    logins.write_text("71,ip,fail,1700000042\nnot-a-number,ip,fail,x\n71,ip,fail,1700000043\n")
    out = tmp_path / "out"
    main(["login_fail_burst", "--input", str(logins), "--mode", "permissive", "--out", str(out)])
    rows = spark.read.parquet(str(out)).collect()
    assert [(r.user_id, r.fails) for r in rows] == [(71, 2)]


def test_cli_stream_once_resumes(spark, tmp_path):
    import uuid
    src = tmp_path / "logins"
    src.mkdir()
    (src / "a.csv").write_text("71,ip,fail,1700000042\n71,ip,fail,1700000043\n")
    out, name = tmp_path / "out", f"cli_{uuid.uuid4().hex[:8]}"
    args = ["login_fail_consecutive", "--input", str(src), "--stream", "--once", "--out", str(out),
            "--name", name]
    main(args)
    assert spark.read.parquet(str(out)).count() == 0          # watermark has not passed yet
    (src / "b.csv").write_text("71,ip,fail,1700000044\n7,ip,fail,1700009999\n")
    main(args)                                                 # resumes from its checkpoint
    got = sorted((r.user_id, r.start_time, r.end_time) for r in spark.read.parquet(str(out)).collect())
    assert [g[0] for g in got] == [71, 71]


def test_cli_booleans_and_url_report(spark, tmp_path):
    log = tmp_path / "access.log"
    log.write_text("".join(f"10.0.0.1 - - 02/03/2024:10:05:{k:02d} +0000 GET /{u}\n" for k, u in
                           enumerate(["a.css", "a.css", "page"])))
    for value, urls in (("false", {"/a.css", "/page"}), ("true", {"/page"})):
        out = tmp_path / f"out-{value}"
        main(["hot_urls", "--input", str(log), "--param", f"exclude_static={value}", "--out", str(out)])
        assert {r.url for r in spark.read.parquet(str(out)).collect()} == urls
    out = tmp_path / "report"
    main(["hot_urls_report", "--input", str(log), "--out", str(out)])
    assert any("No.1 url=/a.css count=2" in r.report for r in spark.read.parquet(str(out)).collect())


def test_cli_quarantines_and_counts_bad_lines(spark, tmp_path, capsys):
    logins = tmp_path / "logins.csv"
    logins.write_text("71,ip,fail,1700000042\nshort\n\n71,ip,fail,1700000043\n")
    main(["login_fail_burst", "--input", str(logins), "--mode", "permissive", "--out", str(tmp_path / "o"),
          "--quarantine", str(tmp_path / "q")])
    assert "2 malformed lines" in capsys.readouterr().err
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/q/input=0").collect()) == ["", "short"]


def test_cli_streams_marketing_and_side_outputs(spark, tmp_path):
    import uuid
    src = tmp_path / "marketing"
    src.mkdir()
    (src / "a.csv").write_text("u1,INSTALL,web,1700000000123\nu2,UNINSTALL,web,1700000000124\nu3,CLICK,app,1700900000000\n")
    for job, cnt in (("marketing_by_channel", 360), ("marketing_total", 360)):
        out = tmp_path / job
        main([job, "--input", str(src), "--stream", "--once", "--out", str(out), "--name", f"cli_{uuid.uuid4().hex[:8]}"])
        assert spark.read.parquet(str(out)).count() == cnt
    orders = tmp_path / "orders"
    orders.mkdir()
    (orders / "a.csv").write_text("1,create,,1700000000\n1,pay,t1,1700000060\n2,create,,1700000000\n")
    (orders / "b.csv").write_text("9,create,,1700900000\n")
    out = tmp_path / "tags"
    main(["order_outcomes", "--input", str(orders), "--stream", "--once", "--out", str(out), "--name", f"cli_{uuid.uuid4().hex[:8]}"])
    got = {(r.order_id, r.outcome, r.msg) for r in spark.read.parquet(str(out)).collect()}
    assert got == {(1, "paid", "order paid in time"), (2, "unpaid", "order not paid within its limit")}
    assert {p.name for p in out.iterdir() if p.is_dir() and "=" in p.name} == {"outcome=paid", "outcome=unpaid"}


def test_cli_other_sources_need_a_stream(tmp_path):
    import pytest
    with pytest.raises(SystemExit):
        main(["hot_items", "--source", "kafka", "--input", "broker:9092/behaviour"])


def test_cli_lateness_reports_each_revision(spark, tmp_path):
    """Late rows revise the ranking of any top-N job and its report, without a change log."""
    from tidewatch import cli
    src, rows = tmp_path / "in", [("1,7,1,pv,", t) for t in (100, 200)] + [("1,8,1,pv,", t) for t in (150, 3700)]
    src.mkdir()
    (src / "a.csv").write_text("".join(f"{r}{t}\n" for r, t in rows))
    argv = ["hot_items_report", "--input", str(src), "--stream", "--once", "--lateness", "2 hours", "--out", str(tmp_path / "out"),
            "--name", f"late-{tmp_path.name}", "--param", "slide=30 minutes"]
    cli.main(argv)
    (src / "b.csv").write_text("".join(f"1,8,1,pv,{t}\n" for t in (300, 310)))
    cli.main(argv)
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("batch").collect()
    reports = [r.report for r in found if "time: 1970-01-01 01:00:00" in r.report]
    assert len(reports) == 2 and "No.1 item=7 count=2" in reports[0] and "No.1 item=8 count=3" in reports[1]
    assert not (tmp_path / "out-changes").exists()
