from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random
from pathlib import Path

from gridtide.llm import warc

SCHEMA = "id long, url string, payload string, extra string"


def written(spark, tmp_path, rows, **options):
    path = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2, "url"), path, **options)
    return path


def read(spark, path):
    rows = warc.read_archives(spark, path).collect()
    return {r.record_id: r for r in rows}, rows


ROWS = [
    (1, "http://a.org/x y", "same", "e"),
    (2, "http://b.org", "same", "e"),
    (3, None, None, None),
    (4, "http://c.org/\r\nX: 1", "", "e"),
    (5, "http://é.org", "é" * 70_000, "e"),
    (None, "http://d.org", "same", "e"),
    (6, "http://e.org", "other\r\n\r\nWARC/1.1\r\n", "e"),
]


def test_round_trip(spark, tmp_path):
    path = written(spark, tmp_path, ROWS)
    by_id, rows = read(spark, path)
    assert len(rows) == len(ROWS) and {r.problem for r in rows} == {None}
    payloads = {row[0]: (row[2] or "").encode() for row in ROWS}
    for number, data in payloads.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (by_id[number].payload_bytes, by_id[number].payload_digest) == (len(data), digest)
    kinds = {n: (r.record_type, r.refers_to) for n, r in by_id.items()}
    assert kinds == {
        1: ("revisit", 2),
        2: ("response", None),
        3: ("revisit", 4),
        4: ("response", None),
        5: ("response", None),
        None: ("revisit", 2),
        6: ("response", None),
    }
    stored = warc.read_archives(spark, path, with_payload=True).where("record_type = 'response'")
    assert {r.record_id: bytes(r.payload) for r in stored.collect()} == {
        n: payloads[n] for n in (2, 4, 5, 6)
    }


def test_archives_are_plain_gzip_with_a_member_per_record(spark, tmp_path):
    path = written(spark, tmp_path, ROWS)
    members = []
    for part in Path(path).glob("part-*"):
        data = part.read_bytes()
        members += list(warc.read_members(io.BytesIO(data)))
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") == data.count(b"\x1f\x8b\x08\x00")
    assert len(members) == len(ROWS)


def test_small_payloads_may_be_left_out_of_the_comparison(spark, tmp_path):
    by_id, _ = read(spark, written(spark, tmp_path, ROWS, min_bytes=1))
    assert by_id[3].record_type == by_id[4].record_type == "response"
    assert by_id[1].record_type == "revisit"


def test_repeated_rows_and_empty_table(spark, tmp_path):
    _, rows = read(spark, written(spark, tmp_path / "a", [ROWS[1], ROWS[1], ROWS[0]]))
    assert sorted((r.record_id, r.record_type) for r in rows) == [
        (1, "revisit"),
        (2, "response"),
        (2, "response"),
    ]
    empty = written(spark, tmp_path / "b", [])
    assert warc.read_archives(spark, empty).count() == 0


def problems(data: bytes) -> list:
    return [
        x if isinstance(x, str) else warc.parse(x)["problem"]
        for x in warc.read_members(io.BytesIO(data))
    ]


def test_damage_is_reported():
    whole = warc.record(7, "http://a", b"payload", None, "2024-01-01T00:00:00Z")
    good = warc.member(whole)
    assert problems(good + good) == [None, None]
    assert problems(good + good[:-9]) == [None, "truncated member"]
    assert problems(good + b"junk") == [None, "damaged member"]
    assert problems(warc.member(whole.replace(b"payload", b"pAyload"))) == ["block digest"]
    assert problems(warc.member(whole[:-1])) == ["content length"]
    assert problems(warc.member(b"nothing")) == ["no record header"]


def test_members_of_16_mib_and_more_are_followed_by_padding():
    large = warc.member(warc.record(7, "http://a", bytes(17 << 20), None, "2024-01-01T00:00:00Z"))
    assert large[-1] != 0
    assert problems(large + b"\0" + large) == [None, None]


def test_records_behind_a_damaged_member_are_found():
    """Every byte of the second of five members is damaged in turn, and stretches of it are cut out."""
    whole = [warc.record(n, "http://a", bytes(f"payload {n} " * (n % 3 * 9 + 1), "ascii"), None, "d") for n in range(5)]
    members = [warc.member(data) for data in whole]
    second = members[1]
    for at in range(len(second)):
        damaged = second[:at] + bytes([second[at] ^ 0x55]) + second[at + 1 :]
        got = list(warc.read_members(io.BytesIO(members[0] + damaged + b"".join(members[2:]))))
        assert got[0] == whole[0] and got[-3:] == whole[2:], at
        assert [x for x in got[1:-3] if not isinstance(x, str)] in ([], [whole[1]]), at
    for start, end in ((0, 1), (0, 20), (5, 60), (30, len(second)), (len(second) - 9, len(second))):
        cut = second[:start] + second[end:]
        got = list(warc.read_members(io.BytesIO(members[0] + cut + b"".join(members[2:]))))
        assert got[0] == whole[0] and got[-3:] == whole[2:] and len(got) == 5, (start, end)


def test_damage_in_long_archives_and_false_starts(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 97)
    whole = [warc.record(n, "http://a", random.Random(n).randbytes(3000), None, "d") for n in range(12)]
    members = [warc.member(data) for data in whole]
    members[4] = members[4][:700] + b"\x1f\x8b\x08\0" + members[4][704:]
    members[8] = b"\x1f\x8b\x08" * 50
    got = list(warc.read_members(io.BytesIO(b"".join(members))))
    assert [x for x in got if not isinstance(x, str)] == [d for n, d in enumerate(whole) if n not in (4, 8)]
    assert len(problems(members[8])) == 1
