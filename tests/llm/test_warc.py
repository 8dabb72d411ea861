import io
import random

import pytest

from ontime.llm import warc

PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "http://d/", ""), (5, "http://e/", "é" * 5000),
         (6, "http://f/", "<p>x</p>"), (6, "http://f/", "<p>x</p>"), (None, "http://n/", "lonely"), (None, "http://n/", "<p>x</p>"), (9, "u", "WARC/1.1\r\n\r\n")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id bigint, url string, html string, _digest string, _bytes int").repartition(3)


def test_round_trip(spark, pages, tmp_path):
    archives = warc.write_warc(pages, str(tmp_path / "w"), max_archive_bytes=400)
    assert sum(r.records for r in archives.collect()) == len(PAGES)
    assert {r.path for r in warc.archives_in(spark, str(tmp_path / "w")).collect()} == {
        "file:" + r.path for r in archives.collect()} or archives.count() > 1
    rows = warc.read_warc(archives).withColumn("page_id", warc.page_of("record_id")).withColumn("refers", warc.page_of("refers_to")).collect()
    assert all(r.gap is None for r in rows)
    got = sorted(((r.page_id, r.record_type, r.refers, r.payload_bytes, r.payload_digest) for r in rows), key=str)
    largest = {}
    for p, _, h in PAGES:
        if p is not None:
            largest[h or ""] = max(largest.get(h or "", -1), p)
    want = []
    for p, _, h in PAGES:
        top = largest.get(h or "")
        kind = "response" if p == top else "revisit"
        data = (h or "").encode()
        want.append((p, kind, None if p == top else top, len(data), warc.base32_sha1(data)))
    assert got == sorted(want, key=str)
    bodies = {r.page_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert bodies[5] == ("é" * 5000).encode() and bodies[9] == b"WARC/1.1\r\n\r\n" and bodies[4] == b""


def test_empty_and_minimum(spark, pages, tmp_path):
    none = warc.write_warc(pages.limit(0), str(tmp_path / "none"))
    assert none.count() == 0 and warc.read_warc(none).count() == 0
    some = warc.read_warc(warc.write_warc(pages, str(tmp_path / "some"), min_revisit_bytes=1)).collect()
    assert sorted(warc_id.record_type for warc_id in some if warc_id.payload_bytes == 0) == ["response", "response"]


def records(n=30, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        body = bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 20, 3000])))
        out.append(warc.record_bytes("response", f"urn:x:{i}", "http://x/", body, warc.base32_sha1(body), len(body), None))
    return out


def read(data):
    items = list(warc.salvage(io.BytesIO(data)))
    at = 0
    for _, start, end, _, _ in items:  # every byte is in one record or gap
        assert start == at and end > start
        at = end
    assert at == len(data)
    return ([i[3]["warc-record-id"] for i in items if i[0] == "record"], [(i[1], i[2], i[3]) for i in items if i[0] == "gap"])


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_what_is_whole(packed):
    parts = [warc.gzip_member(r) if packed else r for r in records()]
    names = [f"<urn:x:{i}>" for i in range(30)]
    assert read(b"".join(parts)) == (names, [])
    rnd = random.Random(7)
    for _ in range(40):
        broken, hurt = list(parts), set()
        for _ in range(rnd.randint(1, 3)):
            i = rnd.randrange(30)
            hurt.add(i)
            kind = rnd.choice(["cut", "flip", "junk"])
            p = bytearray(broken[i])
            if kind == "cut":
                p = p[: rnd.randrange(len(p))]
            elif kind == "flip":
                # a plain record's header has no checksum, so only its block can be seen to be wrong
                start = 0 if packed else bytes(p).find(b"\r\n\r\n") + 4
                p[rnd.randrange(start, len(p))] ^= 0xFF
            else:
                p = bytearray(bytes(rnd.randrange(256) for _ in range(50))) + p
                hurt.discard(i) if broken[i] == parts[i] else None
            broken[i] = bytes(p)
        found, gaps = read(b"".join(broken))
        assert [n for n in names if n in found] == found  # in order, none twice
        assert {n for i, n in enumerate(names) if i not in hurt} <= set(found) | {names[i - 1] for i in hurt if i}
    assert read(b"") == ([], [])
    assert read(b"garbage")[0] == []


def test_gap_reasons():
    a, b = records(2)
    flipped = bytearray(warc.gzip_member(a))
    flipped[-6] ^= 1
    found, gaps = read(bytes(flipped) + warc.gzip_member(b))
    assert found == ["<urn:x:1>"] and gaps == [(0, len(flipped), "gzip checksum or data")]
    wrong = warc.record_bytes("response", "urn:x:9", "u", b"abc", "X", 3, None).replace(b"abc", b"abd")
    assert read(wrong + b)[1] == [(0, len(wrong), "block digest differs")]
    assert read(a[:-3])[1][0][2] == "truncated record"


def test_member_of_several_records():
    parts = records()
    whole, one = warc.gzip_member(b"".join(parts)), warc.gzip_member(parts[0])

    def ids(items):
        return [i[3]["warc-record-id"] for i in items if i[0] == "record"]

    items = list(warc.salvage(io.BytesIO(whole + one)))
    assert ids(items) == [f"<urn:x:{i}>" for i in range(30)] + ["<urn:x:0>"] and len(items) == 31
    assert {i[1:3] for i in items[:30]} == {(0, len(whole))} and items[30][1:3] == (len(whole), len(whole) + len(one))
    for broken in (0, 4, 29):
        hurt = [b"junk" + p[20:] if i == broken else p for i, p in enumerate(parts)]
        items = list(warc.salvage(io.BytesIO(warc.gzip_member(b"".join(hurt)) + one)))
        assert ids(items) == [f"<urn:x:{i}>" for i in range(30) if i != broken] + ["<urn:x:0>"]
        assert len([i for i in items if i[0] == "gap"]) == 1
    items = list(warc.salvage(io.BytesIO(warc.gzip_member(parts[0] + b"tail"))))
    assert [i[0] for i in items] == ["record", "gap"] and items[0][4] == warc.parse_record(parts[0])[1]


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        got = super().read(n)
        self.taken += len(got)
        return got


@pytest.mark.parametrize("packed", [True, False])
def test_long_records_are_read_a_bounded_number_of_times(packed):
    body = random.Random(3).randbytes(8 << 20)
    long = warc.record_bytes("response", "urn:x:long", "u", body, "X", len(body), None)
    data = b"".join(warc.gzip_member(p) if packed else p for p in [*records(), long, *records()])
    f = Counting(data)
    items = list(warc.salvage(f))
    assert [i[0] for i in items] == ["record"] * 61 and items[30][4] == body
    assert f.taken < 2 * len(data)


@pytest.mark.parametrize("length", [b"10", b"50000", b"999999999999", b"9" * 5000])
def test_wrong_lengths_cost_little(length):
    parts = records(400)
    hurt = [p.replace(p[p.index(b"Content-Length"):].split(b"\r\n")[0], b"Content-Length: " + length) if i % 2 == 0 else p
            for i, p in enumerate(parts)]
    f = Counting(b"".join(hurt))
    found = [i[3]["warc-record-id"] for i in warc.salvage(f) if i[0] == "record"]
    assert set(f"<urn:x:{i}>" for i in range(1, 400, 2)) <= set(found)
    assert f.taken < 500 * warc._READ  # a step of reading ahead for each damaged record at most


def test_junk_after_a_version_line_is_not_a_header():
    whole = records(1)[0]
    f = Counting(b"WARC/1.1\r\n" + b"no colon\r\n" * 200000 + whole)
    items = list(warc.salvage(f))
    assert [i[0] for i in items] == ["gap", "record"] and items[0][3] == "bad header line"
    assert f.taken < 2 * len(f.getvalue())
