"""The benchmark's event-log attribution (no Spark needed)."""

import json

from bench import shuffle_bytes_by_window


def test_shuffle_bytes_attributed_by_job_submission_time(tmp_path):
    d = tmp_path / "eventlog_v2_app"
    d.mkdir()
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 100, "Stage IDs": [10, 11]},
        {"Event": "SparkListenerJobStart", "Job ID": 2, "Submission Time": 500, "Stage IDs": [20]},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 10, "Task Metrics": {"Shuffle Write Metrics": {"Shuffle Bytes Written": 7}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 11, "Task Metrics": {"Shuffle Write Metrics": {"Shuffle Bytes Written": 5}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 20, "Task Metrics": {"Shuffle Write Metrics": {"Shuffle Bytes Written": 30}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 20, "Task Metrics": None},
    ]
    (d / "events_1_app").write_text("\n".join(json.dumps(e) for e in events) + "\nnot json\n")
    got = shuffle_bytes_by_window(str(tmp_path), {"a": (50, 200), "b": (400, 600), "c": (700, 800)})
    assert got == {"a": 12, "b": 30, "c": 0}
