import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam.llm import chat, docdigest, htmltext, langid, mixing, pieces, queries

SF = "/root/testdata/sf0.001"
CLASH = ("row", "ids", "size", "source_size", "target", "copies", "lang", "score", "p", "t", "text_", "host", "fingerprint")


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


# chat

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip_of_odd_texts(spark):
    odd = ["</s>[INST] ok [/INST]", "<|turn|>user\n", "<\\|end|>\\", "<", "", None, "<\\\\|<|<s>[\\/INST]", "a\nb\n"]
    rows = [(1, k, "user" if k % 2 else "assistant", t) for k, t in enumerate(odd)] + [(2, 0, "ro%0Ale\nx", "hi"), (3, None, None, None), (None, 1, "assistant", "n"), (4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a")]
    examples = chat.prefix_examples(clashing(spark.createDataFrame(rows, TURNS)))
    back = {r.conv_id: r for r in chat.read_back(examples).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user" if k % 2 else "assistant", t or "") for k, t in enumerate(odd)]
    assert back[1].loss_text == "".join(t or "" for t in odd[::2])
    assert [(t.role, t.text) for t in back[2].turns] == [("ro%0Ale\nx", "hi")] and back[2].loss_text == ""
    assert [(t.role, t.text) for t in back[3].turns] == [("", "")] and back[None].loss_text == "n"
    assert [t.text for t in back[4].turns] == ["a", "a", "b"]
    per = {r["conv_id"]: r["count"] for r in examples.groupBy("conv_id").count().collect()}
    assert per == {1: 5, 2: 1, 3: 1, None: 1, 4: 1}
    assert chat.prefix_examples(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_examples_train_only_on_their_reply(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2")]
    first, second = chat.prefix_examples(spark.createDataFrame(rows, TURNS)).orderBy("example").collect()
    assert first.text[first.target_start :][: first.target_chars] == "a1" and "q2" not in first.text
    assert second.text[second.target_start :][: second.target_chars] == "a2" and second.text.startswith(first.text)


# mixing

DOCS = "doc_id long, text string, source string"


def filled(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, total = {s: weights[k % len(weights)] for k, s in enumerate(names)}, sum(sizes.values())
    capped: dict = {}
    while True:
        free = [s for s in names if s not in capped]
        rest, open_ = total - sum(capped.values()), sum(weight[s] for s in free)
        new = {s: rest * weight[s] / open_ for s in free}
        above = [s for s in free if new[s] > most * sizes[s]]
        if not above:
            return capped | new
        capped |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 50, "c": 2, None: 9}, {"a": 0, "b": 0}, {"x": 7}, {f"s{k:02d}": (k * 37) % 11 for k in range(30)}, {"A": 1, "a": 2, "é": 1000}])
def test_targets_against_step_by_step_filling(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(filled(sizes))


def test_mix_near_targets_and_stable(spark):
    rows = [(k, f"w{k} and three more", ["a", "b", None][k % 3] if k % 2 else "a") for k in range(3000)] + [(None, None, "z"), (1, "", "q"), (1, "", "q")]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    plan = mixing.repetition_plan(docs).toPandas()
    assert len(plan) == len(rows) and (plan.copies <= 3).all()
    taken = (plan.copies * plan["size"]).groupby(plan.row.map(lambda r: r["source"]), dropna=False).sum()
    target = plan.groupby(plan.row.map(lambda r: r["source"]), dropna=False).target.first()
    assert np.allclose(taken, target, rtol=0.08)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs.repartition(5)).count() == mixing.mix(docs).count() == plan.copies.sum()
    assert mixing.mix(docs.limit(0)).count() == 0


# pieces


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load(queries.PIECE_MODEL)


def library(model: pieces.PieceModel) -> sentencepiece.SentencePieceProcessor:
    """The same pieces and scores in the library's own unigram encoder."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    for p, s, t in zip(model.pieces, model.scores, model.kinds, strict=True):
        proto.pieces.add(piece=p, score=float(s), type=t)
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = 6 in model.kinds
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = model.dummy_prefix
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def small_model() -> pieces.PieceModel:
    normal = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "abc", "é", "▁▁", "ca", "aa", "aab", "日本"]
    scores = [-3.5, -2.25, -2.5, -2.75, -3.0, -3.25, -2.0, -4.5, -5.5, -6.0, -3.0, -4.0, -4.5, -6.75, -5.0]
    named = ["<unk>", "<s>", "</s>", *(f"<0x{b:02X}>" for b in range(256)), *normal]
    return pieces.PieceModel(named, np.array([0.0] * 259 + scores), [2, 3, 3] + [6] * 256 + [1] * len(normal))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcé日本 \nxZ☃", max_size=30))
def test_unigram_equals_the_library(text):
    ours, theirs = small_model().prepared(), library(small_model())
    ids = ours.encode([text])[0]
    assert ids == theirs.encode(text)
    assert ours.decode(ids) == text == theirs.decode(ids)


def test_model_without_bytes_gives_unknown_pieces():
    model = small_model()
    keep = [k for k, t in enumerate(model.kinds) if t != 6]
    bare = pieces.PieceModel([model.pieces[k] for k in keep], model.scores[keep], [model.kinds[k] for k in keep]).prepared()
    assert bare.encode(["x"]) == [[bare.model.pieces.index("▁"), 0]]


def test_real_model_finds_the_best_path_of_each_word(model):
    segmenter = model.prepared()
    score = {p: s for p, s, t in zip(model.pieces, model.scores, model.kinds, strict=True) if t == 1}
    for word in ["▁retitioning", "▁the", "▁Éçhérè", "▁aaaaaaa", "▁http://x.y/z1234"]:
        best = [0.0] + [-np.inf] * len(word)
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + 20) + 1):
                s = score.get(word[i:j], segmenter.lowest if j == i + 1 else -np.inf)
                best[j] = max(best[j], best[i] + s)
        ids = segmenter.encode([word[1:]])[0]
        assert sum(model.scores[i] for i in ids if model.kinds[i] == 1) + segmenter.lowest * len({k for k, c in enumerate(word) if c not in score}) == best[-1]


def test_encode_and_decode_columns(spark, model):
    long = "word " * 30000 + "x" * 3000
    texts = [None, "", " ", "a  b\n\tc", "日本語 ☃ \U0001f600", long, "dup", "dup"]
    docs = clashing(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    found = pieces.encoded(docs, model)
    out = {r.d: (r.ids, r.back) for r in found.select(F.col("row.doc_id").alias("d"), "ids", pieces.decoder(model)("ids").alias("back")).collect()}
    assert [out[k][1] for k in range(len(texts))] == texts
    assert out[0][0] is None and out[1][0] == [] and out[6] == out[7]
    assert found.select("row.*").columns == docs.columns and pieces.encoded(docs.limit(0), model).count() == 0


def test_texts_without_spaces_are_cut_where_no_piece_crosses(model):
    import time

    rng = np.random.default_rng(0)
    chinese = "".join(chr(0x4E00 + int(k)) for k in rng.integers(0, 5000, 340_000))
    segmenter, began = model.prepared(), time.process_time()
    ids = segmenter.encode([chinese, "x" * 300_000])
    assert time.process_time() - began < 20 and not any(len(c) > pieces.KEPT_BYTES for c in segmenter.known)
    assert segmenter.decode(ids[0]) == chinese and segmenter.decode(ids[1]) == "x" * 300_000


def test_a_few_long_parts_one_by_one(monkeypatch):
    text = "aab" * 3000 + "caab" * 900
    ids = small_model().prepared().encode([text, "ab"])
    monkeypatch.setattr(pieces, "FEW", 0)
    assert small_model().prepared().encode([text, "ab"]) == ids and library(small_model()).encode(text) == ids[0]


def test_the_cache_is_bounded(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_BYTES", 5000)
    segmenter = model.prepared()
    for k in range(20):
        segmenter.encode([" ".join(f"word{k}{n}" for n in range(30))])
        assert len(segmenter.known) < 60


def test_models_with_other_normalization_are_refused(tmp_path, model):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.pieces.add(piece="a", score=0.0, type=1)
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceModel.load(str(tmp_path / "m"))


# language


def test_language_accuracy_on_held_out_rows(spark):
    out = queries.op9_langid(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id")
    assert len(out) == len(docs) and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.index]).all()
    held = out[out.held_out]
    assert (held.lang_pred == docs.lang.reindex(held.index)).mean() > 0.97
    assert out.accepted.mean() > 0.98


def test_language_of_odd_rows(spark):
    labelled = spark.createDataFrame([(k, "the cat sat on the mat and was there " * 3, "en") for k in range(5)] + [(k + 9, "der hund ist in dem haus und nicht hier " * 3, "de") for k in range(5)] + [(99, "x", None), (98, None, "fr")], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(1, "THE cat was on the mat"), (2, None), (3, "123 !?"), (4, ""), (None, "der hund ist nicht in dem haus"), (6, "the cat " * 30000), (6, "the cat " * 30000)], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "lang", "score", "p", "accepted")})
    out = [(r.d, r.l, r.a) for r in langid.identified(docs, labelled).select(F.col("row.doc_id").alias("d"), F.col("lang").alias("l"), F.col("accepted").alias("a")).collect()]
    assert out == [(1, "en", True), (2, "und", False), (3, "und", False), (4, "und", False), (None, "de", True), (6, "en", True), (6, "en", True)]
    none = langid.identified(docs, labelled.limit(0))
    assert {(r.lang, r.score, r.accepted) for r in none.select("lang", "score", "accepted").collect()} == {("und", 0.0, False)}
    assert langid.identified(docs.limit(0), labelled).count() == 0


def test_op9_against_brute_force(spark):
    """Dictionaries, sizes and scores made anew, text by text."""
    import re

    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("h", F.xxhash64("doc_id")).toPandas()
    fold = lambda text: re.sub(r"[\W\d_]+", " ", text.lower()).encode()
    learn = docs[np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in docs.doc_id]) & docs.lang.notna()].sort_values("h")
    coders = {}
    for lang, rows in learn.groupby("lang"):
        found = []
        for text, h in zip(rows.text[:128], rows.h[:128], strict=True):
            at = h % (max(0, len(text) - 1000) + 1)
            found.append(text[at : at + 1000])
        data = b"\n".join(fold(x) for x in dict.fromkeys(found[::-1]))
        params = zstandard.ZstdCompressionParameters.from_level(6, source_size=2048, dict_size=len(data), write_content_size=False, write_dict_id=False)
        coders[lang] = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)
    expected = {}
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        raw = fold(text)
        sizes = sorted((sum(len(c.compress(raw[a : a + 2048])) for a in range(0, len(raw), 2048)), lang) for lang, c in coders.items())
        expected[i] = (sizes[0][1], 1 - sizes[0][0] / sizes[1][0]) if any(c.isalpha() for c in text) else ("und", 0.0)
    assert {r.doc_id: (r.lang_pred, r.score) for r in queries.op9_langid(spark, SF).collect()} == expected


def test_ambiguous_text_is_rejected():
    coders = langid.compressors({"a": b"one two three four five six" * 3, "b": b"one two three four five six" * 3})
    assert langid.classified("seven eight", coders) == ("a", 0.0)


# digests


def brute_digest(text: str) -> str:
    raw, counts = text.encode(), [0] * docdigest.BUCKETS
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        counts[((a | b << 8 | c << 16) * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    q = sorted(counts)
    cuts = [q[63], q[127], q[191]]
    bits = "".join(f"{sum(c > x for x in cuts):02b}" for c in counts)
    return f"{min(255, round(8 * np.log2(len(raw) + 1))):02x}{int(bits, 2):0128x}"


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "hello wörld " * 50, "x" * 5000])
def test_digest(text, monkeypatch):
    monkeypatch.setattr(docdigest, "COUNT_ROWS", 17)
    assert docdigest.digest(text.encode()) == brute_digest(text)


def test_likeness_is_bounded_and_symmetric():
    a, b = (docdigest.digest(t.encode()) for t in ("one text " * 40, "and quite another"))
    assert docdigest.likeness(a, a) == 1 and 0 <= docdigest.likeness(a, b) == docdigest.likeness(b, a) < 1
    assert docdigest.likeness("00" + "0" * 128, "ff" + "f" * 128) == 0


def test_edit_comparison_against_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(["abcdefgh" * 9, None, "", "é日本x" * 7, "short", "word " * 20000, "same text here", "same text here"])] + [(3, "é日本x" * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("fingerprint", "n_chars", "part", "edge")})
    got = docdigest.edit_comparison(docs).toPandas()
    texts = [t or "" for _, t in sorted(rows, key=lambda r: r[0])]
    expected = []
    for own, after in zip(texts, texts[1:] + texts[:1], strict=True):
        n = len(own) // 4
        changed = own[: len(own) - n] + after[:n]
        expected.append((len(own), hashlib.sha256(changed.encode()).hexdigest(), brute_digest(own), brute_digest(changed), round(docdigest.likeness(brute_digest(own), brute_digest(changed)), 12), round(docdigest.likeness(brute_digest(own), brute_digest(after)), 12)))
    cols = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(expected) == sorted(map(tuple, got[cols].round(12).itertuples(index=False)))
    assert docdigest.edit_comparison(docs.limit(0)).count() == 0
    one = docdigest.edit_comparison(docs.filter("doc_id = 4")).first()
    assert one.near_next == 1.0


def test_op7_over_the_table(spark):
    out = queries.op7_docdigest(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").toPandas()
    assert list(out.doc_id) == list(docs.doc_id) and list(out.n_chars) == list(docs.text.str.len())
    following = list(docs.text[1:]) + [docs.text[0]]
    assert list(out.fingerprint) == [brute_digest(t) for t in docs.text]
    assert list(out.edited_fingerprint) == [brute_digest(docdigest.edited(a, b)) for a, b in zip(docs.text, list(docs.text[1:]) + [docs.text[0]], strict=True)]
    assert list(out.edited_sha256) == [hashlib.sha256(docdigest.edited(a, b).encode()).hexdigest() for a, b in zip(docs.text, following, strict=True)]
    assert (out.near_edited > out.near_next).mean() > 0.9


# html

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header class="site"><p>Site name</p></header><nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="post-12 content"><h1>The &amp; title</h1><p>First <b>para</b>graph,<br>second&nbsp;line with enough words to count as text.
<p>Next one &lt;not a tag&gt; with <a href="x">a link</a> and more words.<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>
<div class="ad-box">Buy now</div><form><p>Your mail</p></form></div>
<aside>Side</aside><div class="comments"><p>A reader says a lot of things here, even more than the article, on and on and on and on and on, and so the comment is long.</p></div>
<footer><p>&copy; 2020</p></footer></body></html>"""


def test_page_text():
    page = htmltext.Page(PAGE)
    path = 0
    for own in ("html", "body.has-sidebar", "div.content.post-#"):
        path = htmltext.path_id(path, own)
    assert page.best().path == path
    assert page.text([]) == "The & title\nFirst paragraph, second line with enough words to count as text.\nNext one <not a tag> with a link and more words.\none\ntwo\nc1\nc2"


def test_class_words_leave_inline_elements_quotations_and_code():
    page = """<article><p>See <span class='comment'># keep this</span>, <span class='legal'>s. 5</span> and <a class='related' href=x>a link</a>.</p>
    <blockquote class='reply'>quoted</blockquote><pre><code>x = 1 <span class="comment"># one</span></code></pre><div class='notice'>Mind this.</div>
    <p>As <math><mi>a</mi><mo>=</mo><mn>2</mn></math> shows.</p><noscript><p>Plain.</p></noscript><div class="share">Share me</div><section class="comments"><p>First!</p></section></article>"""
    assert htmltext.Page(page).text([]) == "See # keep this, s. 5 and a link.\nquoted\nx = 1 # one\nMind this.\nAs a=2 shows.\nPlain."


@pytest.mark.parametrize("html", ["<" + "a" * 10_000_000, "<a " * 3_400_000, "<a '" * 2_500_000 + ">", "<div>" * 100_000 + "x" + "</div>" * 100_000, "<b>" * 100_000 + "<hr>" * 100_000, "<ul><li>" * 50_000 + "x", "</x>" * 100_000, "<!--" * 100_000, "<script>" * 100_000])
def test_time_is_in_proportion_to_the_page(html):
    import time

    began = time.process_time()
    htmltext.Page(html).text([1])
    assert time.process_time() - began < 10


@pytest.mark.parametrize(("html", "text"), [("", ""), ("just text", "just text"), ("<p>", ""), ("<script>x", ""), ("<!-- <p>no</p> --><p>yes", "yes"), ("<p>a &am b</p>", "a &am b"), ("a < b", "a < b"), ("<div><p>x</div></p></div>y", "x\ny"), ("<br/>", ""), ("a <b c", "a <b c"), ("<p title='x>y</p>z", "y\nz"), ("<body><p>intro</p><div>" + "more words " * 9 + "</div></body>", "intro\n" + ("more words " * 9).strip()), ("<body><div class='lead'>" + "one two " * 9 + "</div><div class='rest'>" + "three four " * 20 + "</div></body>", ("one two " * 9).strip() + "\n" + ("three four " * 20).strip()), ("<p>" + "long " * 50000, ("long " * 50000).strip())])
def test_odd_pages(html, text):
    assert htmltext.Page(html).text([]) == text


def test_sections_of_an_article_stay_together():
    section = "<section><h2>Part {0}</h2><p>" + "text of part {0} " * 20 + "</p></section>"
    body = "".join(section.format(k) for k in range(3)) + section.format(9).replace("text", "longer text") * 3
    for page in (f"<main><div>{body}</div></main>", f"<article><header><h1>T</h1></header><div class='body'>{body}</div></article>", f"<div class='wrap'><div>Menu</div><div>{body}</div></div>"):
        text = htmltext.Page(f"<body>{page}<p>Some other words</p></body>").text([])
        assert all(f"Part {k}" in text for k in (0, 1, 2, 9))
        assert ("other words" in text) == ("wrap" in page)  # without an article, all prose stays
        assert ("T\n" in text) == ("<h1>" in page)


def test_host_consensus_beats_a_page_of_its_own(spark):
    usual = "<body><div class='x1'><p>{}</p></div><div class='y'>a line</div></body>"
    odd = "<body><div class='x22'><p>{}</p></div><div class='z'><p>{}</p></div></body>"
    long, short = "many words of the article " * 6, "a few words of the rest " * 3
    rows = [(k, f"http://h.org/{k}", usual.format(long)) for k in range(5)] + [(9, "http://H.org/9", odd.format(long, short)), (10, None, odd.format(long, short)), (None, "http://h.org/n", None), (9, "http://H.org/9", odd.format(long, short))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "paths", "path", "text", "votes")})
    out = {(r.page_id, r.url): r.text for r in htmltext.main_text(pages).collect()}
    # on the usual pages a bare line lies outside the host's path; on the odd one prose does, which stays
    assert out[(0, "http://h.org/0")] == long.strip()
    assert out[(9, "http://H.org/9")] == out[(10, None)] == f"{long.strip()}\n{short.strip()}" and out[(None, "http://h.org/n")] == ""
    assert htmltext.main_text(pages).count() == len(rows) and htmltext.main_text(pages.limit(0)).count() == 0
    # every template of a host may win
    votes = spark.createDataFrame([("h", k, 10 - k) for k in range(8)] + [("h", 99, 0)], "host string, path long, votes long")
    assert htmltext.winning_paths(votes).first().paths == list(range(8))


def test_op10_finds_the_articles(spark):
    import re
    from html import unescape

    out = {r.page_id: r.text for r in queries.op10_htmltext(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?p>|</?h1>", inner)]
        assert out[r.page_id] == "\n".join(x for x in lines if x)


