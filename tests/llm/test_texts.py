"""Tokenizers, personal data, wrappers and classifiers."""

import functools
import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from clickspark.llm import byte_bpe, html_wrapper, pii, quality_cnn, token_counts, toxicity

from tests.llm.conftest import odd_texts, prose


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.ByteBPE(byte_bpe._read(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)


def random_texts(n, seed):
    r = random.Random(seed)
    alphabet = list("abEéß́漢Σ1२,.!-_'<|> \n\t\x1c\x1f\x85\xa0​") + ["<|endoftext|>", "'s", "İ", "\U0001f600"]
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(n)]


def test_bpe_equals_the_library(codec):
    lib = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    hard = ["a" * 3000, "xq" * 2000, " " * 700 + "a", "\n" * 300, "zyzzyva" * 300, "0123456789" * 200]
    for t in hard + random_texts(3000, 1) + [t or "" for _, t in odd_texts()]:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_bpe_of_odd_rows(docs, clashing, no_docs):
    out = byte_bpe.encode_decode(clashing[0], P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in out.collect()) == sorted(
        (str(i), (t or "").encode()) for i, t in odd_texts())
    assert byte_bpe.encode_decode(no_docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_counts_equal_the_library():
    data = byte_bpe._read(P.path("word_bpe_49k.json"))
    lib = Tokenizer.from_str(data.decode())
    plain = token_counts.Counter(data)
    small = [token_counts.Counter(data, chunk=c, overlap=o) for c, o in ((10, 2), (23, 9), (64, 16))]
    for t in random_texts(3000, 2) + [prose(1, 3000), "w" * 500, "é" * 200 + " " + "x" * 90]:
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert [plain.count(t)] + [c.count(t) for c in small] == [n] * 4


def test_counts_of_odd_rows(docs, clashing, no_docs):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = token_counts.count_tokens(clashing[0], P.path("word_bpe_49k.json"), chunk=4000, limit=100).collect()
    want = sorted((str(i), len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids))
                  for i, t in odd_texts())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in out)
    assert token_counts.count_tokens(no_docs, P.path("word_bpe_49k.json")).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def test_emails_equal_the_pattern():
    r = random.Random(4)
    for _ in range(5000):
        t = "".join(r.choice("ab.@-1 _+") for _ in range(r.randrange(25)))
        assert pii.emails(t) == [m.span() for m in EMAIL.finditer(t)]


@pytest.mark.parametrize("text, kind, found", [
    ("x john.doe (at) example (dot) com y", "email", "john.doe (at) example (dot) com"),
    ("jane at mail dot example dot org!", "email", "jane at mail dot example dot org"),
    ("јohn@exаmple.com", "email", "јohn@exаmple.com"),
    ("a​lice@exam​ple.com", "email", "a​lice@exam​ple.com"),
    ("＋１ ２０６ ５５５ ０１００", "phone", None),
    ("call plus one two zero six five five five oh one zero zero now", "phone",
     "plus one two zero six five five five oh one zero zero"),
    ("card four one one one 1111 1111 one one one one", "card", "four one one one 1111 1111 one one one one"),
    ("one nine two dot one six eight dot one dot one", "ip", None)])
def test_disguises_map_back_to_the_source(text, kind, found):
    base, added = pii.spans(text)
    assert not any(base.values())
    assert [text[a:b] for a, b in added[kind]] == [found or text]
    assert f"[{kind.upper()}]" in pii.redact_text(text)


@pytest.mark.parametrize("text", [
    "we met at noon and sat on the dot", "un deux trois", "look at this. dot by dot", "1.2.3", "a < b > c",
    "Version 2.0 at once", "(at) the (dot)"])
def test_clean_texts_have_no_spans(text):
    base, added = pii.spans(text)
    assert not any(base.values()) and not any(added.values())
    assert pii.redact_text(text) == text


@pytest.mark.parametrize("text, found", [
    ("soy juan arroba ejemplo punto com gracias", "juan arroba ejemplo punto com"),
    ("juan arroba ejemplo.com", "juan arroba ejemplo.com"), ("max at beispiel punkt de", "max at beispiel punkt de"),
    ("jean arroba exemple point fr", "jean arroba exemple point fr"),
    ("ana (arroba) correo punto ejemplo punto es", "ana (arroba) correo punto ejemplo punto es"),
    ("john at example dot com", "john at example dot com")])
def test_words_of_other_languages_without_brackets(text, found):
    base, added = pii.spans(text)
    assert not any(base.values()) and [text[a:b] for a, b in added["email"]] == [found]


@pytest.mark.parametrize("text", ["look at this point in time", "en este punto de la arroba", "der punkt ist da",
                                  "una arroba de trigo", "at one point we stopped", "see us at example.com"])
def test_the_same_words_in_prose(text):
    base, added = pii.spans(text)
    assert not any(base.values()) and not any(added.values())


def test_base_spans_and_their_checks():
    t = "a@b.co 10.0.0.256 10.0.0.25 4111 1111 1111 1111 4111 1111 1111 1112 +44 (20) 7946-0958 +1 2"
    base, _ = pii.spans(t)
    assert {k: [t[a:b] for a, b in v] for k, v in base.items()} == {
        "email": ["a@b.co"], "ip": ["10.0.0.25"], "card": [], "phone": ["+44 (20) 7946-0958"]}
    one = "4111 1111 1111 1111"
    assert pii.detect(one)["card"] == [(0, len(one))]


def test_pii_of_odd_rows(docs, clashing, no_docs):
    found = {(r.doc_id, len(r.base)) for r in pii.find(clashing[0]).collect()}
    assert (12, 2) in found and (4, 0) in found
    done = pii.redact(clashing[0])
    assert done.columns == clashing[0].columns
    texts = {r[0]: r[1] for r in done.collect()}
    assert "[EMAIL]" in texts[12] and "[PHONE]" in texts[12] and texts[4] is None and texts[5] == ""
    assert pii.find(no_docs).count() == pii.redact(no_docs).count() == 0


def page(body, title="t", extra=""):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';"
            f"</script></head><body><header>Site name</header><nav><ul><li><a href=/>Home</a><li><a href=/x>"
            f"{title}</a></ul></nav><div class='cookie-notice'>We use cookies</div>{body}{extra}"
            f"<aside>Side</aside><form><p>Join</p></form><footer>&copy; site</footer></body></html>")


def wrap_all(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_wrapper.main_text(df).collect()}


def test_articles_and_odd_pages(spark):
    art = "<article><h1>Ti &amp; tle</h1><p><b>One\n two<br><p>three&nbsp;four &am{}</article>"
    talk = "<section class=comments><p>first!</p></section>"
    rows = [(i, "http://A.example/x", page(art.format(i), str(i), talk * (i % 2))) for i in range(6)]
    rows += [(10, None, None), (11, "nonsense", ""), (12, "http://a.example/", "plain < text"),
             (13, "http://a.example/", "<article><p>cut off <i>her"), (13, "http://a.example/", rows[0][2]),
             (14, "http://deep.example/", "<div>" * 5000 + "<article>deep</article>"),
             (15, "http://b.example/", "<article><ul><li>a<li>b</ul>tail<div class=ad>buy</div></article>")]
    got = wrap_all(spark, [r for r in rows if r[0] != 13] + [rows[9]])
    for i in range(6):
        assert got[i] == f"Ti & tle\nOne two\nthree four &am{i}"
    assert got[10] == got[11] == "" and got[13] == "cut off her" and got[15] == "a\nb\ntail"
    assert html_wrapper.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_content_without_article_is_what_varies(spark):
    rows = [(i, "http://c.example/", page(f"<div id=wrap><div class=top>Daily news</div><div class=body>"
                                          f"<p>{prose(i, 50)}</p><p>{prose(i + 50, 30)}</p></div></div>", "t"))
            for i in range(5)]
    got = wrap_all(spark, rows)
    for i in range(5):
        assert got[i] == prose(i, 50) + "\n" + prose(i + 50, 30)


def test_pages_without_a_smaller_root(spark):
    rows = [(i, "http://f.example/", f"<h1>{prose(i, 5)}</h1><p>{prose(i + 20, 30)}</p><p>{prose(i + 40, 30)}</p>")
            for i in range(5)]
    rows += [(i, "http://g.example/", f"<h1>{prose(i, 5)}</h1><p>{prose(i + 20, 30)}</p>") for i in range(10, 15)]
    rows += [(i, "http://p.example/", prose(i, 20)) for i in range(20, 24)]
    same = page(f"<div><p>{prose(1, 30)}</p><p>{prose(2, 30)}</p></div>")
    rows += [(i, "http://s.example/", same) for i in range(30, 33)]
    got = wrap_all(spark, rows)
    for i in range(5):
        assert got[i] == "\n".join([prose(i, 5), prose(i + 20, 30), prose(i + 40, 30)])
    for i in range(10, 15):
        assert got[i] == prose(i, 5) + "\n" + prose(i + 20, 30)
    assert [got[i] for i in range(20, 24)] == [prose(i, 20) for i in range(20, 24)]
    assert [got[i] for i in range(30, 33)] == [prose(1, 30) + "\n" + prose(2, 30)] * 3


def test_roots_are_chosen_page_by_page(spark):
    def body(i):
        return f"<p>{prose(i, 40)}</p><p>{prose(i + 100, 30)}</p>"

    def text(i):
        return prose(i, 40) + "\n" + prose(i + 100, 30)
    rows = [(i, "http://mix.example/", page(f"<article>{body(i)}</article>")) for i in range(6)]
    rows += [(6, "http://mix.example/", page(f"<main>{body(6)}</main>")),
             (7, "http://mix.example/", page(f"<div class=old>{body(7)}</div>")),
             (8, "http://mix.example/", page(f"<article></article><div class=old>{body(8)}</div>")),
             (9, "http://mix.example/", "plain < text")]
    rows += [(i, "http://two.example/", page(f"<div class={'story' if i % 3 == 0 else 'content'}>{body(i)}</div>"))
             for i in range(20, 30)]
    rows += [(i, None, page(f"<article>{body(i)}</article>" if i % 2 else f"<div>{body(i)}</div>"))
             for i in range(40, 46)]
    got = wrap_all(spark, rows)
    assert got.pop(9) == "plain < text"
    assert got == {i: text(i) for i in got} and len(got) == len(rows) - 1


@pytest.mark.parametrize("before, after, roots", [
    ("<body class='no-sidebar'>", "</body>", "article main div"),
    ("<body class='page has-sidebar menu-open'>", "</body>", "article main div"),
    ("<body class=sidebar>", "</body>", "article main div"),
    ("<div class='content-sidebar-wrap'>", "</div>", "article main div"),
    ("<div id='page-header-wrap'>", "</div>", "article main div"),
    ("<div class=sidebar>", "</div>", "article main"), ("<form id=aspnetForm>", "</form>", "article main")])
def test_content_inside_boilerplate_words(before, after, roots):
    for root in roots.split():
        pages = [html_wrapper.parse(
            f"<html>{before}<div class='left-sidebar'>Side</div><div class='cookie-notice'>We use cookies</div>"
            f"<{root}><p>{prose(i, 30)}</p><p>{prose(i + 9, 30)}</p></{root}>"
            f"<div class=comments><article><p>first!</p></article></div>{after}<p>&copy;</p></html>") for i in range(6)]
        wrapper = html_wrapper.weigh(functools.reduce(html_wrapper.merge, map(html_wrapper.shape, pages)))
        for i, p in enumerate(pages):
            assert html_wrapper.extract(p, wrapper) == prose(i, 30) + "\n" + prose(i + 9, 30)


def test_boilerplate_names():
    for name in ("ad", "cookie-notice", "left-sidebar", "site-header", "comment.comments", "x.nav", "post-comments",
                 "footer_links", "main-nav", "breadcrumbs", "ad-box"):
        assert html_wrapper.excluded("div." + name, "div")
    for name in ("no-sidebar", "has-sidebar", "menu-open", "content-sidebar-wrap", "page-header-wrap", "main",
                 "post", "article", "readme", "shared-space", "main-content"):
        assert not html_wrapper.excluded("div." + name, "div")


def test_only_what_all_pages_have_is_template(spark):
    def body(i, more=""):
        return f"<div class=a><p>{prose(i, 30)}</p>{more}</div><div class=b><p>{prose(i + 500, 30)}</p></div>"

    top = "<div class=top>Daily news</div>"
    rows = [(i, "http://c.example/", page(top + body(i, "<h3>Summary</h3>"))) for i in range(20)]
    copied = page(top + body(99) + "<div class=note>Only here</div>")
    rows += [(i, "http://c.example/", copied) for i in range(20, 24)]
    answers = "<div class=q>" + "".join(f"<h3>Answer</h3><p>{prose(i, 20)}</p>" for i in range(4)) + "</div>"
    table = "<table>" + "<tr><td>yes</td></tr>" * 4 + "</table>"
    rows += [(30, "http://q.example/", page(answers)), (31, "http://t.example/", page(f"<div>{table}</div>"))]
    rows += [(i, "http://s.example/", page(body(7), str(i)).replace("var t", f"var t{i}")) for i in range(40, 50)]
    got = wrap_all(spark, rows)
    for i in range(20):
        assert got[i] == "\n".join([prose(i, 30), "Summary", prose(i + 500, 30)])
    for i in range(20, 24):
        assert got[i] == "\n".join([prose(99, 30), prose(599, 30), "Only here"])
    assert got[30] == "\n".join("Answer\n" + prose(i, 20) for i in range(4)) and got[31] == "\n".join(["yes"] * 4)
    assert {got[i] for i in range(40, 50)} == {prose(7, 30) + "\n" + prose(507, 30)}


def test_template_is_told_from_all_pages_of_a_host(spark):
    rows, n = [], 512
    for i in range(n):  # 64 pages on each of 8 hosts; a part of them may all have what only most have
        note = "<div class=note>Most have it</div>" if i // 8 % 8 else ""
        line = "<div class=line>Nearly all have it</div>" if i // 8 % 16 else ""
        rows.append((i, f"http://c{i % 8}.example/", page(
            f"{note}{line}<div class=a><p>{prose(i, 30)}</p></div><div class=b><p>{prose(i + 900, 30)}</p></div>")))
    rows += [(n + i, *rows[0][1:]) for i in range(40)]  # copies are one page
    got = wrap_all(spark, rows)
    for i in range(n):
        assert got[i] == ("Most have it\n" if i // 8 % 8 else "") + prose(i, 30) + "\n" + prose(i + 900, 30)
    known = html_wrapper.wrappers(spark.createDataFrame(rows, "page_id long, url string, html string")
                                  .selectExpr("url AS host", "html")).collect()
    known = {r.host: json.loads(r.wrapper) for r in known}
    assert {w["d"] for w in known.values()} == {64} and sum(w["n"] for w in known.values()) == n + 40
    copies = [html_wrapper.shape(html_wrapper.parse(f"<p>{c}</p>")) for c in (1, 2)]
    assert html_wrapper.merge(*copies, copies=True)["d"] == 1 and html_wrapper.merge(*copies)["d"] == 2


def test_wrapper_is_union_free():
    a = html_wrapper.shape(html_wrapper.parse("<div><h1>x</h1><p>a<p>b</div>"))
    b = html_wrapper.shape(html_wrapper.parse("<div><h1>x</h1><p>c<hr><table><tr><td>1</table></div>"))
    assert html_wrapper.expression(html_wrapper.merge(a, b)) == (
        "<><div><h1>#text</h1>(<p>#text</p>)+(<table><tr><td>#text</td></tr></table>)?</div></>")


TOXIC = ["idiot", "moron", "scum"]


def labelled(n, junk=False):
    out = []
    for i in range(n):
        w = prose(i, 60).split()
        bad = i % 4 == 0
        if bad:
            for k in (7, 23, 41):
                w[k] = TOXIC[(i + k) % 3] if not junk else "###$$$" + w[k]
        out.append((" ".join(w), int(bad)))
    return out


def test_toxicity_separates_held_out_texts():
    rows = labelled(400)
    model = toxicity.Model([t for t, _ in rows[:300]], [y for _, y in rows[:300]])
    score = model.score([t for t, _ in rows[300:]] + ["", prose(7777, 20_000)])
    assert ((score[:-2] >= 0.3) == [y == 1 for _, y in rows[300:]]).mean() > 0.95
    assert score[-1] < 0.3 and score[-2] < 0.3  # also a very long clean text
    planted = prose(7777, 3000) + " " + "you idiot moron scum " * 3 + prose(8, 3000)
    assert model.score([planted])[0] > model.score([prose(7777, 6000)])[0]


def glued(seed, n, stems, mark=None, share=0.02):
    """Words of three stems; with a mark, some of them begin with it.  Its two
    stems also meet by chance."""
    r = random.Random(seed)
    return " ".join(mark + r.choice(stems) if mark and r.random() < share
                    else "".join(r.choice(stems) for _ in range(3)) for _ in range(n))


def test_toxic_marks_inside_words_of_two_languages():
    r = random.Random(9)
    north = ["ach", "lich"] + ["".join(r.choice("bdfgklmnprstwzäöü") + r.choice("aeiou") for _ in range(2))
                               for _ in range(80)]
    south = ["ré", "eux"] + ["".join(r.choice("cdfglmnprstvç") + r.choice("aeiouéè") for _ in range(2))
                             for _ in range(80)]
    tongues = ((north, "achlich"), (south, "réeux"))
    rows = []
    for i in range(600):
        stems, mark = tongues[i % 2]
        y = int(i % 6 < 2)
        rows.append((glued(i, 150 + 37 * i % 400, stems, mark if y else None, 0.04), y, i % 2))
    train, test = rows[:400], rows[400:]
    plain, bad = ([toxicity.normalise(t) for t, y, _ in train if y == c] for c in (0, 1))
    marks = toxicity.telling(plain, bad)
    found = {p for t in bad for p in toxicity.pieces(t, marks)}
    assert any(b"achlich" in p for p in found) and any("réeux".encode() in p for p in found)
    model = toxicity.Model([t for t, _, _ in train], [y for _, y, _ in train])
    score = model.score([t for t, _, _ in test])
    for tongue in (0, 1):
        toxic = [s for s, (_, y, k) in zip(score, test) if y and k == tongue]
        clean = [s for s, (_, y, k) in zip(score, test) if not y and k == tongue]
        assert np.mean(np.array(toxic) >= 0.3) > 0.8
        assert np.mean(np.array(toxic)[:, None] > np.array(clean)[None, :]) > 0.95


def test_a_toxic_passage_in_a_long_text_reaches_the_cut():
    rows = labelled(400)
    model = toxicity.Model([t for t, _ in rows], [y for _, y in rows])
    for n in (200, 1000, 3000):
        planted = prose(7777, n) + " " + "you idiot moron scum " * 6 + prose(8, n)
        assert model.score([planted])[0] >= 0.3 > model.score([prose(7777, 2 * n)])[0]


@pytest.mark.parametrize("lang, least", [("en", 0.8), ("de", 0.6), ("fr", 0.85), ("es", 0.8)])
def test_held_out_recall_by_language(toxic_scores, lang, least):
    """Against ``labels.toxic`` on the held-out fold; ``lang`` is read here only."""
    toxic = [s for s, y, k in toxic_scores if y and k == lang]
    clean = [s for s, y, k in toxic_scores if not y and k == lang]
    assert np.mean(np.array(toxic) >= 0.3) >= least and np.mean(np.array(clean) >= 0.3) < 0.2


@pytest.fixture(scope="module")
def toxic_scores():
    import pyarrow.parquet as pq
    base = "/root/testdata/sf0.1"
    docs = {r["doc_id"]: r for r in pq.read_table(f"{base}/documents.parquet").to_pylist()}
    rows = [(docs[r["doc_id"]], r["toxic"]) for r in pq.read_table(f"{base}/labels.parquet").to_pylist()
            if r["toxic"] is not None and docs[r["doc_id"]]["text"]]
    out = [zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2 for d, _ in rows]
    train = [(d["text"], y) for (d, y), held in zip(rows, out) if not held and len(d["text"]) <= 20_000]
    some = [r for r in train if r[1]] + [r for r in train if not r[1]][:toxicity.MAX_TRAIN]
    model = toxicity.Model([t for t, _ in some], [y for _, y in some], np.mean([y for _, y in train]))
    test = [r for r, held in zip(rows, out) if held]
    return [(s, y, d["lang"]) for s, (d, y) in zip(model.score([d["text"] for d, _ in test]), test)]


def test_quality_network_separates_held_out_texts():
    rows = [(t, 1 - y) for t, y in labelled(300, junk=True)]
    net = quality_cnn.Network([t for t, _ in rows[:220]], [y for _, y in rows[:220]], 0.75)
    score = net.score([t for t, _ in rows[220:]] + ["", prose(5, 9000)])
    assert ((score[:-2] >= 0.5) == [y == 1 for _, y in rows[220:]]).mean() > 0.95
    assert 0 <= score.min() and score.max() <= 1


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        t = prose(n, n)[:n] if n else ""
        rows = quality_cnn.chunks(t)
        seen = np.zeros(max(n, 1), bool)
        for k in range(len(rows)):
            seen[k * quality_cnn.STEP:k * quality_cnn.STEP + quality_cnn.CHUNK] = True
        assert seen.all() and (rows[0][:min(n, 256)] & 255 == np.frombuffer(t.encode(), np.uint8)[:256]).all()


def test_classifiers_of_odd_rows(spark, docs, clashing, no_docs):
    data = labelled(160)
    train = spark.createDataFrame([(i + 1000, t) for i, (t, _) in enumerate(data)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i + 1000, y, y) for i, (_, y) in enumerate(data)] + [(1, None, None), (None, 1, 1), (1003, 0, 0)],
        "doc_id long, toxic int, quality int")
    for op, folds, fold in ((toxicity, 4, 2), (quality_cnn, 5, 0)):
        model = op.fit(train, labels)
        out = op.score(clashing[0], model).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
        assert all(r.predicted == (r.score >= 0.3) for r in out)
        assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % folds == fold)
                   for r in out)
        assert op.score(no_docs, model).count() == 0
        none = op.fit(train, labels.limit(0))
        assert {r.score for r in op.score(docs, none).collect()} == {0.0}
    model = toxicity.fit(train, labels)
    kept = toxicity.keep_clean(clashing[0], model)
    ids = [r[0] for r in kept.collect()]
    assert kept.columns == clashing[0].columns and 11 not in ids and 1 in ids and 4 in ids


def test_digest_columns(docs):
    r = pii.find(docs).where("doc_id = 12").first()
    t = dict(odd_texts())[12]
    assert [t[s["start"]:s["end"]] for s in r.base] == ["a@b.example.com", "+1 (206) 555-0100"]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
        "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def plain_spans(text):
    """The four base patterns of all kinds, as they are written."""
    def luhn(d):
        return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_of_all_kinds_against_the_patterns(spark):
    r = random.Random(12)
    parts = ["a@b.c", "x.y@", "@z.de", "1.2.3.4", "256.1.1.1", "01.002.3.255", "1.2.3", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+49 (30) 123-4567", "+1", "+12345678901234567890", ".", "..", " ", "-",
             "7", "0", "1.2.3.4.5.6.7.8", "(", ")", "é", "9999999999999999", "user%x+y@mail-1.example.org"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 14))) for _ in range(4000)]
    for t in texts:
        got = [(k, *s) for k, spans in pii.detect(t).items() for s in spans]
        assert got == plain_spans(t), t
    df = spark.createDataFrame(list(enumerate(texts[:300])), "doc_id long, text string")
    from clickspark.llm import queries
    monkey = queries.table
    queries.table = lambda *a: df
    try:
        rows = {x.doc_id: x for x in queries.QUERIES["op8_pii_spans"](spark, "").collect()}
    finally:
        queries.table = monkey
    for i, t in enumerate(texts[:300]):
        want = plain_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert rows[i].n_ip == sum(k == "ip" for k, _, _ in want)


def within(seconds, fn, *args):
    import time
    start = time.time()
    out = fn(*args)
    assert time.time() - start < seconds
    return out


def test_a_megabyte_of_anything_ends():
    n = 1 << 20
    for text in ("1" * n, "1." * (n // 2), " " * n, "a @ b" + " " * n, "(" * n, " at " * (n // 4), "+" * n,
                 "1 " * (n // 2), "a" * n, "x@" * (n // 2), " dot" + "\n" * n):
        within(20, pii.detect, text)
        within(20, pii._disguises, text)
    assert pii.detect("1" * n + ".1.1.1 1.2.3.4")["ip"] == [(n + 7, n + 14)]
    page = "<html><body><article><p>" + "a<b>b</b>" * (n // 8) + "</p></article></body></html>"
    tree = within(20, html_wrapper.parse, page)
    assert within(20, html_wrapper.extract, tree, None) == "ab" * (n // 8)


def test_unbroken_texts_are_counted_in_linear_time():
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        data = f.read()
    counter = token_counts.Counter(data, 2000, 64)
    r = random.Random(3)
    word = "".join(r.choice("abcdefgh.,-") for _ in range(200_000))
    for text in (word, "one two " + word + " three four", word[:50_000] + " " + word[:70_000] + "  x " + word[:9000],
                 " " * 30_000 + word[:30_000], "\n".join(word[i:i + 3001] for i in range(0, 60_000, 3001))):
        want, = counter.library([text])
        assert within(60, counter.count_huge, text) == want


def test_the_wrapper_decides_on_all_given_pages(sf_dir):
    """On sf0.1 every page is read through its host's wrapper, and what tags
    alone would give is the same."""
    import pyarrow.parquet as pq
    rows = pq.read_table("/root/testdata/sf0.1/pages.parquet").to_pylist()
    pages = [(r["url"].split("/")[2].lower(), html_wrapper.parse(r["html"] or "")) for r in rows]
    known = {}
    for host, page in pages:
        node = html_wrapper.shape(page)
        known[host] = html_wrapper.merge(known[host], node) if host in known else node
    known = {h: html_wrapper.weigh(w) for h, w in known.items()}
    told = 0
    for host, page in pages:
        w = known[host]
        told += bool(w["w"] and w["n"] >= html_wrapper.TELLING and html_wrapper.found(page, w))
        assert html_wrapper.extract(page, w) == html_wrapper.explicit(page)
    assert told == len(pages)
