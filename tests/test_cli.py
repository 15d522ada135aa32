from __future__ import annotations

import json

from tests.conftest import line
from txnlake.__main__ import main, parser


def test_a_whole_day_from_the_command_line(spark, tmp_path, capsys):
    def run(*argv):
        main(["--dataset", str(tmp_path / "ds"), *argv])
        return [json.loads(text) for text in capsys.readouterr().out.splitlines()]

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "1.json").write_text(line(amount=50) + "\n" + line(amount=10, transaction_id="t2"))
    (raw / "empty.json").write_text("")
    run("create-tables")
    counts = run("batch", "--input_path", f"{raw}/*.json", "--anomaly_amount_threshold", "20")
    assert (counts[0]["valid"], counts[0]["anomalies_flagged"]) == (2, 1)
    run(
        "stream", "--source", "files", "--input", f"{raw}/*.json",
        "--checkpoint", str(tmp_path / "cp"), "--available_now",
    )
    assert len(run("transactions", "--limit", "3", "--user_id", "u1")) == 3
    assert [a["transaction_id"] for a in run("anomalies")] == ["t1"]
    assert run("stats")[0]["total_transactions"] == 4
    assert run("sql", "SELECT count(*) AS n FROM anomalies JOIN transactions USING (transaction_id)")[0]["n"] == 2
    found = run("sql", "SELECT * FROM top_users(:as_of) WHERE user_id = :u", "--arg", "as_of=TIMESTAMP '2024-01-31'", "--arg", "u='u1'")
    assert [(r["user_id"], r["transaction_count"]) for r in found] == [("u1", 4)]
    # One day of transactions and of both summaries has two batches.
    assert run("compact", "--before", "2030-01-01") == [{"merges": 3}]
    assert run("stats")[0]["total_transactions"] == 4
    requests = tmp_path / "requests.json"
    requests.write_text('{"user_id":"u","amount":1,"currency":"USD","transaction_type":"t","status":"s"}\n{bad\n')
    sent = run("publish", "--input_path", str(requests), "--sink", "text", "--output", str(tmp_path / "sent"))
    assert len(sent) == 1 and set(sent[0]) == {"transaction_id"}
    assert run("report", "processing_lag")[0]["total_processed"] == 0


def test_only_empty_files(spark, tmp_path, capsys):
    (tmp_path / "empty.json").write_text("")
    main(["--dataset", str(tmp_path / "ds"), "create-tables"])
    main(["--dataset", str(tmp_path / "ds"), "batch", "--input_path", str(tmp_path / "*.json")])
    assert set(json.loads(capsys.readouterr().out).values()) == {0}


def test_defaults_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("INPUT_PATH", "/in/*.json")
    monkeypatch.setenv("ANOMALY_AMOUNT_THRESHOLD", "12.5")
    monkeypatch.setenv("TXN_ANOMALIES_TABLE", "odd")
    args = parser().parse_args(["batch"])
    assert (args.input_path, args.anomaly_amount_threshold) == ("/in/*.json", 12.5)
    assert (args.dataset, args.anomalies_table) == ("txn_lake", "odd")
