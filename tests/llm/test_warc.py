import gzip
import hashlib
import os
import re

import pytest

from cartwheel.llm import warc
from cartwheel.llm.common import Scratch
from cartwheel.llm.queries import op10_warc
from cartwheel.llm.sql import ORACLE
from tests.oracle_compare import compare, duck

ROWS = [(k, f"http://h/{k} x\r\ny", f"<p>{'z' * (k * 37 % 4000)}</p>\r\n\r\nWARC/1.1", k) for k in range(120)]
ODD = [(500, None, None, 0), (None, "u", "", 0), (501, "u", "é<b>\r\n\r\n", 0), (501, "u", "é<b>\r\n\r\n", 0),
       (502, "u", "<" * 300_000, 0)]
SCHEMA = "page_id long, url string, html string, place long"


def test_query_matches_sql(spark, sf):
    r = compare(spark, duck(sf), "op10_warc", op10_warc, ORACLE["op10_warc"], sf)
    assert r["status"] == "match", r


def files(folder):
    return sorted(f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("part-"))


def test_records_survive_the_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS + ODD, SCHEMA).coalesce(2)
    warc.write_archive(pages, f"{tmp_path}/a")
    got = [(page, payload.decode()) for f in files(f"{tmp_path}/a")
           for _, _, page, payload in warc.parse(gzip.open(f).read())]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])                          # noqa: E731
    assert sorted(got, key=key) == sorted([(r[0], r[2] or "") for r in ROWS + ODD], key=key)


def test_every_kind_of_damage_is_located(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 20)
    pages = spark.createDataFrame(ROWS + ODD, SCHEMA).coalesce(2)
    for name in "ab":
        warc.write_archive(pages, f"{tmp_path}/{name}")
    same = warc.audit(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert {r.status for r in same.collect()} == {"intact"} and same.count() == len(ROWS + ODD)
    lost, cut, flipped = files(f"{tmp_path}/b")[:3]
    os.remove(lost)
    with gzip.open(cut) as f:
        whole = f.read()
    with gzip.open(cut, "wb") as f:
        f.write(whole[:len(whole) // 2])
    with gzip.open(flipped) as f:
        data = bytearray(f.read())
    at = list(warc.parse(bytes(data)))[4]
    data[at[0] + at[1] - 6] ^= 1
    with gzip.open(flipped, "wb") as f:
        f.write(bytes(data))
    for f in os.listdir(f"{tmp_path}/b"):
        if f.endswith(".crc"):
            os.remove(f"{tmp_path}/b/{f}")
    want = {}
    for f in files(f"{tmp_path}/a"):
        for o, n, _, _ in warc.parse(gzip.open(f).read()):
            want[warc.place_of(f), o] = "intact"
            if f.endswith(os.path.basename(lost)) or warc.place_of(f) == warc.place_of(lost):
                want[warc.place_of(f), o] = "missing"
            if warc.place_of(f) == warc.place_of(cut) and o + n > len(whole) // 2:
                want[warc.place_of(f), o] = "damaged"
            if warc.place_of(f) == warc.place_of(flipped) and o == at[0]:
                want[warc.place_of(f), o] = "damaged"
    got = {(r.place, r.at): r.status for r in warc.audit(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()}
    half = [k for k, v in want.items() if v == "damaged" and k[0] == warc.place_of(cut)]
    for k in half[1:]:                          # after the cut no record starts
        want[k] = "missing"
    assert got == want


def drop_crc(folder):
    for f in os.listdir(folder):
        if f.endswith(".crc"):
            os.remove(f"{folder}/{f}")


def flip(path, at, bit=1):
    with open(path, "rb") as f:
        data = bytearray(f.read())
    data[at] ^= bit
    with open(path, "wb") as f:
        f.write(bytes(data))


def members(path):
    """(start, end) of each stored record."""
    with open(path, "rb") as f:
        data = f.read()
    at = [m.start() for m in warc.MEMBER.finditer(data)]
    return list(zip(at, [*at[1:], len(data)]))


def test_flipped_byte_of_a_stored_file_costs_one_record(spark, tmp_path):
    rows = [(k, f"u{k}", "".join(hashlib.md5(b"%d %d" % (k, j)).hexdigest() for j in range(k % 50)), 0) for k in range(150)]
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    for name in "ab":
        warc.write_archive(pages, f"{tmp_path}/{name}")
    (path,) = files(f"{tmp_path}/b")
    at = members(path)
    assert len(at) == len(rows)
    flip(path, at[10][1] - 6)                               # check sum
    flip(path, at[20][1] - 4)                               # length
    flip(path, at[45][0])                                   # header
    flip(path, (at[49][0] + at[49][1]) // 2, 16)            # data
    flip(path, at[149][1] - 12, 64)                         # data of the last
    drop_crc(f"{tmp_path}/b")
    got = {r.page_id: r.status for r in warc.audit(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()}
    bad = {k: s for k, s in got.items() if s != "intact"}
    assert bad == {10: "damaged", 20: "damaged", 45: "missing", 49: "damaged", 149: "damaged"} and len(got) == len(rows)


def test_damage_to_the_primary_is_located(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 20)
    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    for name in "ab":
        warc.write_archive(pages, f"{tmp_path}/{name}")
    first, cut, hurt = files(f"{tmp_path}/a")[:3]
    os.remove(first)
    with open(cut, "rb") as f:
        data = f.read()
    with open(cut, "wb") as f:
        f.write(data[:members(files(f"{tmp_path}/b")[1])[8][0]])
    flip(hurt, members(hurt)[3][0])                         # header
    os.remove(files(f"{tmp_path}/b")[-1])
    for name in "ab":
        drop_crc(f"{tmp_path}/{name}")
    got = {r.page_id: (r.status, r.n_bytes, r.payload_sha256) for r in warc.audit(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()}
    lost = {*range(20), *range(28, 40), 43}
    for k, _, html, _ in ROWS:
        want = "lost" if k in lost else "missing" if k >= 100 else "intact"
        assert got.pop(k) == (want, len(html), hashlib.sha256(html.encode()).hexdigest())
    assert not got


def test_any_flipped_bit_leaves_the_records_around_it():
    plain = [b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (
        k, len(x), x) for k, x in enumerate(hashlib.sha512(b"%d" % k).hexdigest().encode() * (k % 3) for k in range(5))]
    packed = [warc.pack(p) + b"\0" for p in plain]
    whole, at = b"".join(plain), [len(b"".join(plain[:k])) for k in range(6)]
    assert gzip.decompress(b"".join(packed)) == whole
    assert warc.unzip(b"".join(packed)) == (whole, at[:5], [])
    for bit in range(8 * len(packed[2])):
        hurt = bytearray(packed[2])
        hurt[bit // 8] ^= 1 << bit % 8
        data, starts, _ = warc.unzip(b"".join([*packed[:2], bytes(hurt), *packed[3:]]))
        found = {o: page for o, _, page, _ in warc.parse(data, starts)}
        assert {at[k]: k for k in (0, 1, 3, 4)}.items() <= found.items()
        assert data[:at[2]] + data[at[3]:] == whole[:at[2]] + whole[at[3]:]


def test_long_records_go_on_in_further_members(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 100)
    text = b"WARC/1.1\r\n" * 40
    plain = [b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (k, len(text), text) for k in range(3)]
    data, starts, broken = warc.unzip(b"".join(warc.pack(p) + b"\0" for p in plain))
    assert data == b"".join(plain) and len(starts) == 3 and not broken
    assert [(page, payload) for _, _, page, payload in warc.parse(data, starts)] == [(k, text) for k in range(3)]


def test_descent_skips_equal_branches(spark):
    def leaves(changed):
        rows = [(k << 9, hashlib.md5(b"%d" % (k in changed)).digest()) for k in range(700)]
        return spark.createDataFrame(rows, "place long, digest binary")
    scratch = Scratch(spark)
    a, b = (warc.tree(leaves(c), scratch, 3) for c in ((), (5, 600)))
    assert a[-1].collect() != b[-1].collect()
    assert sorted(r.node for r in warc.differing(a, b, scratch).collect()) == [5 << 9, 600 << 9]


def test_empty_archive(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], SCHEMA), f"{tmp_path}/e")
    assert warc.audit(spark, f"{tmp_path}/e", f"{tmp_path}/e").count() == 0


def test_places_of_many_files_and_ranges_do_not_meet(monkeypatch):
    name = "x/part-{:05d}-8a-c{:03d}.txt".format
    places = [warc.place_of(name(p, n)) for p in (0, 1) for n in (0, 1, 4095, 4096, 5000)]
    assert len(set(places)) == 10 and places == sorted(places)
    assert warc.range_of(places[0], 65_535) < places[1]
    for bad in (lambda: warc.range_of(0, 65_536), lambda: warc.place_of(name(0, 1 << warc.FILE_BITS)),
                lambda: warc.place_of(name(1 << 26, 0))):
        with pytest.raises(ValueError):
            bad()


def test_files_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rows = [(k, None, "".join(hashlib.md5(b"%d %d" % (k, j)).hexdigest() for j in range(60)), 0) for k in range(300)]
    warc.write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"{tmp_path}/a")
    sizes = [os.path.getsize(f) for f in files(f"{tmp_path}/a")]
    assert len(sizes) > 10 and max(sizes) < 23_000
    same = warc.audit(spark, f"{tmp_path}/a", f"{tmp_path}/a").collect()
    assert sorted(r.page_id for r in same) == list(range(300)) and {r.status for r in same} == {"intact"}


def test_records_are_valid_and_named_apart(spark, tmp_path):
    warc.write_archive(spark.createDataFrame(ROWS + ODD, SCHEMA).coalesce(2), f"{tmp_path}/a")
    data = b"".join(gzip.open(f).read() for f in files(f"{tmp_path}/a"))
    heads = re.findall(rb"WARC-Type: resource\r\nWARC-Record-ID: (<[^>]+>)\r\nWARC-Date: (\S+)\r\n", data)
    assert len(heads) == len(ROWS + ODD) == len({h for h, _ in heads})
    assert {d for _, d in heads} == {warc.NO_DATE.encode()}
