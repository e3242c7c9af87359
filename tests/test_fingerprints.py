"""File fingerprints above and below the md5 bound."""

import random

import pytest

from trialframe.sources.store import fingerprint_diff, fingerprints


@pytest.fixture
def folders(tmp_path):
    r = random.Random(5)
    lines = [r.randbytes(r.randrange(400)).replace(b"\n", b"") for _ in range(3_000)]
    whole = b"\n".join(lines)
    turned = b"\n".join([lines[1], lines[0], *lines[2:]])
    byte = whole[:300_000] + bytes([whole[300_000] ^ 1]) + whole[300_001:]
    sides = {"old": {"same": whole, "byte": whole, "order": whole, "grown": b"x", "shrunk": whole, "gone": whole, "tiny": b"a", "edit": b"a"},
             "new": {"same": whole, "byte": byte, "order": turned, "grown": whole, "shrunk": b"x", "new": whole, "tiny": b"a", "edit": b"b"}}
    for side, held in sides.items():
        (tmp_path / side).mkdir()
        for name, data in held.items():
            (tmp_path / side / name).write_bytes(data)
    return tmp_path


def test_large_files_are_same_or_changed_by_content(spark, folders):
    wanted = {"same": "same", "byte": "changed", "order": "changed", "grown": "changed", "shrunk": "changed",
              "gone": "gone", "new": "new", "tiny": "same", "edit": "changed"}
    for bound in (1_000, 1 << 30):          # all large ones by lines, then all by md5
        old, new = (fingerprints(spark, str(folders / s), max_bytes=bound) for s in ("old", "new"))
        assert {r["name"]: r["status"] for r in fingerprint_diff(old, new).collect()} == wanted


def test_line_hash_does_not_depend_on_the_split(spark, folders):
    def hashes():
        return {r["name"]: r["line_hash"] for r in fingerprints(spark, str(folders / "old"), max_bytes=1_000).collect()}
    whole, kept = hashes(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        assert hashes() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert whole["same"].startswith("3000:") and whole["tiny"] is None
