from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from studygraph.llm import alignment, queries
from studygraph.llm.shared import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def reference(texts):
    """All results from whole texts, token by token."""
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    size_a = alignment.ByteLevel(A).bytes
    docs = []
    for text in texts:
        a = first.encode(f" {text or ''}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spelled_a = [size_a[i] for i in a]
        spelled_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [second.id_to_piece(i)]]
        groups = []
        if text and b"".join(spelled_a) == b"".join(spelled_b) == f" {text}".encode():
            x, y = [], []
            ends = [set(np.cumsum([len(s) for s in spelled]).tolist()) for spelled in (spelled_a, spelled_b)]
            both, at, j = ends[0] & ends[1], 0, 0
            reached = 0
            for i, s in zip(a, spelled_a):
                x.append(i)
                at += len(s)
                if at in both:
                    while reached < at:
                        y.append(b[j])
                        reached += len(spelled_b[j])
                        j += 1
                    groups.append((x, y))
                    x, y = [], []
        docs.append(groups)
    count = Counter(pair for groups in docs for pair in {(i, j) for x, y in groups for i in x for j in y})
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    for groups in docs:
        links = [(i, j) for x, y in groups for i in x for j in y]
        line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(line.encode()).hexdigest() if line else "")


def test_all_documents(spark):
    data = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, data, "documents").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_token_alignment"](spark, data).collect()}
    assert got == {d: row for (d, _), row in zip(docs, reference([t for _, t in docs]), strict=True)}


TEXTS = [
    None, "", " ", "  ", "a", "a ", " a  b ", "tab\t and\r\n lines \n", "   x  y", "x   y z", "literal ▁ mark", "<|endoftext|> <s></s> <unk> <0x41>", "naïve Ünïcode 日本語テキスト 🙂🙂 é",
    "aaaaaaaa" * 40, "0123456789" * 20, "x" * 3000, "word " * 30_000, "same same", "same same", "don't 'tis we'll\x00nul\x1c sep\u0085 next", "}\r ;\r );\r >\r\n",
]


def test_cases(spark, monkeypatch):
    frame = spark.createDataFrame([(i if i % 4 else None, t, i, 0, "") for i, t in enumerate(TEXTS)], "doc_id long, text string, nth int, block int, codes string").repartition(3)
    want = sorted(zip((i if i % 4 else -1 for i in range(len(TEXTS))), reference(TEXTS), strict=True))
    got = alignment.align(frame, A, B, with_groups=True).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(r)[1:8]) for r in got) == want
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got if r["groups"])
    assert alignment.align(frame.limit(0), A, B).count() == 0
    assert [tuple(r)[1:] for r in alignment.align(frame.filter("text IS NULL OR text = ''"), A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_small_caches_and_groups(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_UNITS", 3)
    made, fresh = alignment.Aligner(A, B), alignment.Aligner(A, B)
    for text in TEXTS * 2:
        one = made.align(alignment.pa.array([text], alignment.pa.string()))
        fresh.clear()
        other = fresh.align(alignment.pa.array([text], alignment.pa.string()))
        assert all(np.array_equal(x, y) for x, y in zip(one, other, strict=True))
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (np.append(np.sort(rng.choice(59, rng.integers(0, 30), replace=False)) + 1, 60) for _ in range(2))
        both = np.intersect1d(a, b)
        of_a, of_b = alignment.stab(a, b)
        assert (of_a == np.searchsorted(both, a)).all() and (of_b == np.searchsorted(both, b)).all()
