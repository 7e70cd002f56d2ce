import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snaptally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("*", shuffle_partitions=8, app="snaptally-tests")
    s.sparkContext.setLogLevel("ERROR")
    # tests run without a cluster: give the session its own working folder
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def write_file(path, data: bytes | str):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    mode = "wb" if isinstance(data, bytes) else "w"
    with open(path, mode, **({} if isinstance(data, bytes) else {"encoding": "utf-8", "newline": ""})) as f:
        f.write(data)
    return path


# The reference's text fixture (17 lines) and word-count sentences.
INPUT1_LINES = [
    "this", "that", "those", "them", "there", "then", "thick", "thin", "think", "thatch",
    "trash", "thrash", "boat", "bat", "bit", "bin", "baby",
]
SENTENCES = [
    "this is a test", "this is the test", "this is another test",
    "this is about the test", "this is not a test",
]

# JSON record lines and their strict-mode (valid, table, size).
JSON_CASES = [
    ('{"~table":"t","a":1}', True, "t", 20),
    ('{"a":1}', True, "unknown", 7),
    ('{"~table":"t", bad', False, "unknown", 0),
    ("", False, "unknown", 0),
    ("null", False, "unknown", 0),
    ("[1]", False, "unknown", 0),
    ('"abc"', False, "unknown", 0),
    ('{"~table":"t","a":1,"a":2}', False, "unknown", 0),
    ('{"~table":5}', True, "5", 12),
    ('{"~table":{"x":1}}', True, '{"x":1}', 18),
    ("{'~table':'t'}", False, "unknown", 0),
    ('{~table:"t"}', False, "unknown", 0),
    ('{"~table":"t"} x', False, "unknown", 0),
    ('{"~table":null}', True, "unknown", 15),
    ('{"~table":"t"}{"~table":"u"}', False, "unknown", 0),
    ("  ", False, "unknown", 0),
    ('{"~table":"t"},{"~table":"u"}', False, "unknown", 0),
    ('{"~recordSize":9,"~table":"t"}', True, "t", 30),
    (' {"~table":"t"} ', True, "t", 16),
    ('[{"~table":"t"}]', False, "unknown", 0),
    ("{}", True, "unknown", 2),
    ('{"~table":""}', True, "", 13),
    ('{"a":NaN,"~table":"t"}', False, "unknown", 0),
    ('{"~table":"t"}]', False, "unknown", 0),
    ("{a:1}", False, "unknown", 0),
    ('{"~table":"t"}//c', False, "unknown", 0),
    ('{"~table":"t"} ]', False, "unknown", 0),
    ('{"~table":"t"}}', False, "unknown", 0),
    ('{"~table":"t"},"z":1', False, "unknown", 0),
    ('{"~table":"t"},"z"', False, "unknown", 0),
    ('{"~table":true}', True, "true", 15),
    ('{"~table":1.50}', True, "1.5", 15),
]


def final_plan(df) -> str:
    """Physical plan text after execution (the adaptive final plan only)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
