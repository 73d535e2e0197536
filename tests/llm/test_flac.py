from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from studygraph.llm import flac, queries
from studygraph.llm.shared import table


def bits(*fields):
    text = "".join(format(v & ((1 << n) - 1), f"0{n}b") for v, n in fields if n)
    text += "0" * (-len(text) % 8)
    return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))


def framed(subframe, number, size):
    body = flac.frame_header(number, size) + subframe
    crc = 0
    for b in body:  # bit by bit
        crc ^= b << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005) & 0xFFFF if crc & 0x8000 else crc << 1
    return body + crc.to_bytes(2, "big")


def stream(frames, payload):
    info = bytes(2) * 2 + bytes(6) + (8000 << 44 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(bytes(b ^ 0x80 for b in payload)).digest()
    return b"fLaC" + bytes([0x80]) + (34).to_bytes(3, "big") + info + b"".join(frames)


def rice(values, k):
    out = []
    for v in values:
        u = 2 * v if v >= 0 else -2 * v - 1
        out += [(1, (u >> k) + 1), (u, k)]
    return out


def test_all_documents(spark):
    data = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_flac_columns"](spark, data).collect()}
    docs = table(spark, data, "documents").collect()
    assert len(got) == len(docs)
    by_text = {}
    for d in docs:
        raw = (d["text"] or "").encode()
        padded = raw + b" " * (-len(raw) % 192 or 192 * (not raw))
        r = got[d["doc_id"]]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
        assert r["feature"] == flac.feature(np.frombuffer(padded, np.uint8))
        assert by_text.setdefault(d["text"], (r["media_bytes"], r["media_sha256"], r["feature"])) == (r["media_bytes"], r["media_sha256"], r["feature"])


def payloads():
    rng = np.random.default_rng(0)
    wave = np.clip(128 + 100 * np.sin(np.arange(5000) / 20) + rng.normal(0, 2, 5000), 0, 255).astype(np.uint8).tobytes()
    return [b"", b" " * 192, rng.integers(0, 256, 4000, dtype=np.uint8).tobytes(), b"some text " * 2000, b"a", b"ab" * 9, wave, bytes(5000) + b"\xff" * 3000]


def test_round_trip_and_seeking():
    made = flac.encode_streams(payloads())
    assert flac.decode_streams(made) == payloads()
    assert len(made[6]) < 0.6 * 5000 and len(made[7]) < 600
    for payload, s in zip(payloads(), made, strict=True):
        for start, n in ((0, 10), (1150, 5), (2304, 1), (len(payload) - 3, 10), (0, 10**6)):
            assert flac.read_samples(s, max(0, start), n) == payload[max(0, start) : max(0, start) + n]
        # no seek table: frames are found one after the other
        plain = b"fLaC" + b"\x80" + s[5:42] + s[flac.stream_parts(s)[3] :]
        assert flac.decode_streams([plain]) == [payload]


def test_written_by_hand():
    x = [3, 5, -2, 7, 7, 0, -8, 1, 2, 3, -100, 4, 4, 4, 90, -3]
    payload = bytes(v + 128 for v in x)
    verbatim = bits((1 << 1, 8), *[(v, 8) for v in x])
    first = [b - a for a, b in zip(x, x[1:], strict=False)]
    second = [b - a for a, b in zip(first, first[1:], strict=False)]
    # order 1, four partitions of four with their own parameters, the last but one escaped with 9 bits
    parts = bits((9 << 1, 8), (x[0], 8), (0, 2), (2, 4), (2, 4), *rice(first[:3], 2), (0, 4), *rice(first[3:7], 0), (15, 4), (9, 5), *[(v, 9) for v in first[7:11]], (5, 4), *rice(first[11:], 5))
    wide = bits((10 << 1, 8), (x[0], 8), (x[1], 8), (1, 2), (0, 4), (6, 5), *rice(second, 6))  # 5-bit parameters
    predicted = [x[i] - ((3 * x[i - 1] - 2 * x[i - 2]) >> 1) for i in range(2, 16)]
    linear = bits(((32 + 1) << 1, 8), (x[0], 8), (x[1], 8), (3, 4), (1, 5), (3, 4), (-2, 4), (0, 2), (0, 4), (4, 4), *rice(predicted, 4))
    for sub in (verbatim, parts, wide, linear):
        assert flac.decode_streams([stream([framed(sub, 0, 16)], payload)]) == [payload]
    evens = [2 * v for v in range(-8, 8)]
    wasted = bits((1 << 1 | 1, 8), (1, 1), *[(v // 2, 7) for v in evens])
    assert flac.decode_streams([stream([framed(wasted, 0, 16)], bytes(v + 128 for v in evens))]) == [bytes(v + 128 for v in evens)]
    constant = bits((0, 8), (-7, 8))
    assert flac.decode_streams([stream([framed(constant, 0, 300), framed(verbatim, 1, 16)], bytes([121] * 300) + payload)]) == [bytes([121] * 300) + payload]


def test_damage_is_found():
    whole = flac.encode_streams([b"some text, some more text " * 200])[0]
    for at in range(60, len(whole), 37):
        with pytest.raises((flac.Damaged, IndexError, ValueError)):
            broken = bytearray(whole)
            broken[at] ^= 0x10
            if flac.decode_streams([bytes(broken)])[0] == b"some text, some more text " * 200:
                raise flac.Damaged("only the seek table was hit")


def test_numbers_and_checks():
    assert flac.coded_number(0x7F) == b"\x7f" and flac.coded_number(0x80) == "\x80".encode() and flac.coded_number(0x20AC) == "€".encode() and flac.coded_number(0x1F642) == "\U0001f642".encode()
    assert flac.crc8(b"123456789") == 0xF4
    assert flac.crc16(np.frombuffer(b"123456789", np.uint8), np.array([0]), np.array([9]))[0] == 0xFEE8


def test_cases(spark):
    rows = [(1, None, "x"), (2, bytearray(b""), "x"), (3, bytearray(b"text " * 100_000), "x"), (3, bytearray(b"ab"), "x")]
    df = spark.createDataFrame(rows, "doc_id long, payload binary, feature_ string")
    coded = flac.encode(df, "payload")
    got = flac.decode(coded)
    assert sorted((r["doc_id"], r["pcm"] if r["pcm"] is None else bytes(r["pcm"])) for r in got.collect()) == sorted([(i, None if p is None else bytes(p)) for i, p, _ in rows], key=lambda r: (r[0], r[1] or b""))[:2] + sorted((i, bytes(p)) for i, p, _ in rows[2:])
    blocks = flac.pcm_blocks(coded.filter("doc_id = 3"), "doc_id").collect()
    big = sorted((r["sample_offset"], bytes(r["pcm"])) for r in blocks if not (r["sample_offset"] == 0 and r["n_samples"] == 2))
    assert b"".join(p for _, p in big) == b"text " * 100_000 and all(o % flac.BLOCK == 0 for o, _ in big)
    assert flac.decode(flac.encode(df.limit(0), "payload")).count() == 0
