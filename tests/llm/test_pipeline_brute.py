"""The pipeline's stages and op4 over whole tables, against plain versions of what they do."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import zstandard
from test_text_operators import filled

import corpus_pipeline
from loam.llm import langid, pieces, queries, simhash

SF = "/root/testdata/sf0.001"


class PlainPieces:
    """Highest sum of scores, chunk by chunk, by a table of piece strings."""

    def __init__(self, path):
        model = pieces.PieceModel.load(path)
        self.model, self.seen = model, {}
        self.ids = {p: k for k, (p, t) in enumerate(zip(model.pieces, model.kinds, strict=True)) if t == 1}
        self.bytes = {int(p[3:5], 16): k for k, (p, t) in enumerate(zip(model.pieces, model.kinds, strict=True)) if t == 6}
        self.least = min(model.scores[k] for k in self.ids.values()) - 10
        self.longest = max(map(len, self.ids))

    def chunk(self, text):
        if text not in self.seen:
            best = [(0.0, 0, [])] + [None] * len(text)
            for i in range(len(text)):
                for j in range(i + 1, min(len(text), i + self.longest) + 1):
                    k = self.ids.get(text[i:j])
                    if k is None and j > i + 1:
                        continue
                    score = best[i][0] + (self.model.scores[k] if k is not None else self.least)
                    if best[j] is None or score > best[j][0]:
                        best[j] = score, i, [k] if k is not None else [self.bytes[b] for b in text[i:j].encode()]
            out, at = [], len(text)
            while at:
                out = best[at][2] + out
                at = best[at][1]
            self.seen[text] = out
        return self.seen[text]

    def encode(self, text):
        return [i for c in re.findall("▁*[^▁\n]+|▁+|\n", ("▁" + text.replace(" ", "▁")) if text else "") for i in self.chunk(c)]


@pytest.fixture(scope="module")
def plain():
    return PlainPieces(queries.PIECE_MODEL)


def test_op4_over_the_table(spark, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op4_sentencepiece(spark, SF).collect()
    assert {r.doc_id: (r.ids, r.n_tokens, r.decoded_sha256, r.round_trip) for r in out} == {k: ((ids := plain.encode(t)), len(ids), hashlib.sha256(t.encode()).hexdigest(), True) for k, t in docs.items()}


def languages(docs):
    """The documents whose language is clear, by one compressor per language and no shared code but the folding."""
    known = {}
    learn = docs[np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in docs.doc_id]) & docs.lang.notna()]
    order = sorted(learn.index, key=lambda k: (docs.lang[k], docs.h[k], docs.text[k]))
    for lang in sorted(set(learn.lang)):
        chosen = []
        for text, h in [(docs.text[k], docs.h[k]) for k in order if docs.lang[k] == lang][: langid.SAMPLE_TEXTS]:
            at = h % (max(0, len(text) - langid.PIECE_CHARS) + 1)
            chosen.append(text[at : at + langid.PIECE_CHARS])
        known[lang] = "\n".join(map(langid.folded, dict.fromkeys(reversed(chosen)))).encode()
    coders = langid.compressors(known)
    assert all(isinstance(c, zstandard.ZstdCompressor) for c in coders.values())
    keep = []
    for text in docs.text:
        raw = langid.folded(text).encode()
        sizes = sorted(sum(len(c.compress(raw[a : a + langid.CHUNK_BYTES])) for a in range(0, len(raw), langid.CHUNK_BYTES)) for c in coders.values())
        keep.append(any(ch.isalpha() for ch in text) and 1 - sizes[0] / sizes[1] >= langid.MARGIN)
    return docs[keep]


def without_copies(docs):
    sets = [frozenset(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in docs.text]
    names = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if names[i] != names[j] and shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                low, high = sorted((names[i], names[j]))
                names = [low if n == high else n for n in names]
    return docs[[n == k for k, n in enumerate(names)]]


def mixed(docs):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in docs.text]
    by_source: dict = {}
    for s, n in zip(docs.source, sizes, strict=True):
        by_source[s] = by_source.get(s, 0) + n
    target, out = filled(by_source), []
    for i, t, s in zip(docs.doc_id, docs.text, docs.source, strict=True):
        rate = target[s] / by_source[s]
        draw = int(hashlib.md5(f"1|{i}|{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) / 2**52
        out += [(i, t)] * (int(rate) + (draw < rate - int(rate)))
    return out


def test_pipeline_against_plain_stages(spark, plain):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("h", F.xxhash64("doc_id")).orderBy("doc_id").toPandas()
    expected = sorted((i, plain.encode(t)) for i, t in mixed(without_copies(languages(docs)).reset_index(drop=True)))
    got = sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, SF).collect())
    assert len(got) > 100 and got == expected
    assert np.isfinite([len(ids) for _, ids in got]).all()
