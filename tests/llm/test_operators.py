"""The text operators against brute force on small, awkward inputs."""

import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import (
    chat, decontaminate, gru, html_text, language, licenses, lm, mixing, near_dedup, quality, queries, secrets, words,
)

DATA = Path("/root/testdata/sf0.001")
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, copy string, spans string"


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and clashing column names."""
    draw = random.Random(5)
    words = [draw.choice("aeiou") + draw.choice("bcdfglmnrst") + draw.choice("aeiouäé") + str(k % 7) for k in range(300)]
    base = " ".join(draw.choice(words) for _ in range(80))
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, None, "en", None), (3, "one two", "en", "a"),
            (4, "One TWO", "en", "b"), (5, base, "de", "b"), (5, base, "de", "b"), (6, base + " x", None, "c"),
            (7, base.upper(), "de", "c"), (8, "lone" * 20_000, "en", "c"), (9, base + " " + base, "en", None),
            (None, base, "en", "a"), (10, " ".join(draw.choice(words) for _ in range(20_000)), "de", "a"),
            (11, "  \n\t ", "de", "a"), (12, "12 34 !!", "en", "a")]
    for k in range(13, 60):
        text = base.split()
        for _ in range(draw.randrange(6)):
            text[draw.randrange(80)] = draw.choice(words)
        rows.append((k, " ".join(text), draw.choice(["de", "en"]), draw.choice("abc")))
    rows = [(*r, 7, "k", "c", "s") for r in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_duplicates_equal_brute_force(spark, docs):
    sets = {}
    for r in docs.filter("doc_id is not null").collect():
        w = re.findall(WORD, small(r.text))
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    out = near_dedup.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    stay = near_dedup.without_duplicates(docs)
    assert stay.columns == docs.columns
    groups = collections.Counter(comp[r.doc_id] for r in stay.collect() if r.doc_id and sets[r.doc_id])
    assert set(groups.values()) == {1} and set(groups) == {comp[i] for i in sets if sets[i]}


def test_crowded_lists_keep_their_links(spark, monkeypatch):
    """Texts that share most of a passage without being near, and a chain among them."""
    draw = random.Random(8)
    passage = [f"p{k}" for k in range(60)]
    chain = [[*passage, *(f"{d}w{k}" for k in range(30))] for d in range(40)]
    chain += [[*chain[3][:-k], *(f"t{k}x{j}" for j in range(k))] for k in (2, 4, 6)]
    frame = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(draw.sample(chain, len(chain)))], "doc_id long, text string")
    expected = rows(near_dedup.near_duplicates(frame))
    monkeypatch.setattr(near_dedup, "LEADERS", (1,))
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    assert rows(near_dedup.near_duplicates(frame)) == expected
    sets = {k: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for k, t in ((r.doc_id, r.text) for r in frame.collect())}
    near = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    comp = {r[0]: r[2] for r in expected}
    assert near and all(comp[a] == comp[b] for a, b in near)
    assert sum(a != c for a, c in comp.items()) <= len(near)


def test_secret_spans_equal_the_patterns(spark, docs):
    extra = ['é token="abcdefgh12" AKIA1234567890ABCD', "secret: token: abcdefghijk", "password = 1234567", "x" + "0a" * 20]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(90 + k, t) for k, t in enumerate(extra)], "doc_id long, text string"))
    patterns = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 8, 2),
                (re.compile(r"AKIA[A-Z0-9]+"), 16, 0), (re.compile(r"[0-9a-f]+"), 32, 0)]
    texts = {r.doc_id: r.text or "" for r in frame.collect() if r.doc_id is not None}
    for r in secrets.secret_table(frame).filter("doc_id is not null").collect():
        found = sorted((m.start(), k, m.end()) for k, (p, n, g) in enumerate(patterns) for m in p.finditer(texts[r.doc_id]) if len(m[g]) >= n)
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in found) for j in range(3)]
    assert secrets.secret_table(empty(spark)).count() == 0
    clean = secrets.redact(frame).filter("doc_id = 90").first().text
    assert clean == "é [SECRET]\" [SECRET]"  # the closing quote is not in the span


def test_random_strings_are_told_from_prose(spark):
    draw = random.Random(3)
    words = "the Order of hand river stone Blue sky market2 table window paper".split()
    texts = ["".join(draw.choice(secrets.ALPHABETS["base64"]) for _ in range(draw.choice([32, 48, 64]))) for _ in range(100)]
    texts += ["".join(draw.choice(words) for _ in range(9)) + "07" for _ in range(100)]
    frame = spark.createDataFrame([(k, f"see {t} here") for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id for r in secrets.secret_table(frame).filter("n_random > 0").collect()}
    assert len([k for k in found if k < 100]) >= 85 and not [k for k in found if k >= 100]


def test_random_strings_glued_to_names_are_found(spark):
    draw = random.Random(4)
    key = lambda n, kind="base64": "".join(draw.choice(secrets.ALPHABETS[kind]) for _ in range(n))
    forms = ["DB_KEY={}", "https://a.b/c?id=7&sig={}&x=1", "AccountName=ab;AccountKey={}==;E=x", "A_NAME_LONGER_THAN_TWENTY_1={}", "pk_live_{}"]
    texts = [(form.format("{}"), key(60) + "+/") for form in forms for _ in range(40)]
    texts += [("see shop/v1/{}", "_-" + key(60, "base64url")) for _ in range(40)]
    whole = [(k, form.format(value)) for k, (form, value) in enumerate(texts)]
    frame = spark.createDataFrame(whole, "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.secret_table(frame).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(frame).collect()}
    for first in range(0, len(texts), 40):
        full = 0
        for k in range(first, first + 40):
            begin = whole[k][1].index(texts[k][1])
            spans = [tuple(map(int, x.split(":")[1:])) for x in got[k].spans.split(",") if x.startswith("random")]
            assert all(a >= begin or "_live_" in whole[k][1] for a, _ in spans) and len(spans) == got[k].n_random
            full += any(a <= begin and begin + len(texts[k][1]) <= b for a, b in spans) and texts[k][1] not in clean[k]
        assert full >= 34, (texts[first][0], full)


def test_mixture_follows_its_targets(spark, docs):
    out = mixing.mixture_table(docs).collect()
    assert len(out) == docs.count() and all(r.taken <= 2 * r.size for r in out)
    assert rows(mixing.mixture_table(docs)) == sorted((tuple(r) for r in out), key=repr)
    assert mixing.mixture_table(empty(spark)).count() == 0
    targets = {r.source: (r.source_size, r.target) for r in mixing.source_targets(docs.select("source", mixing.word_count(F.col("text")).alias("size"))).collect()}
    assert None in targets and all(t <= 2 * n for n, t in targets.values())
    assert math.isclose(sum(t for _, t in targets.values()), 1.5 * sum(n for n, _ in targets.values()))
    assert mixing.mix(docs).columns == [*[c for c in docs.columns if c != "copy"], "copy"]


def test_languages_and_edge_cases(spark, docs):
    frame = spark.read.parquet(str(DATA / "documents.parquet"))
    out = language.language_table(frame).join(frame.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
    edge = {r.doc_id: r for r in language.language_table(docs).collect()}
    assert all(edge[k].lang_pred == "und" and edge[k].score == 0 for k in (1, 2, 11, 12))
    assert edge[8].lang_pred != "und" and all(0 <= r.score <= 1 for r in edge.values())
    assert language.language_table(empty(spark)).count() == 0


def test_mixed_text_falls_into_spans(spark):
    frame = spark.read.parquet(str(DATA / "documents.parquet"))
    model = language.fit(frame)
    texts = {x: frame.filter((F.col("lang") == x) & (F.length("text") > 500)).first().text.split()[:60] for x in ("en", "de")}
    _, _, spans = language.label([" ".join(texts["en"] + texts["de"])], language.Scorer(model))[0]
    assert [s[0] for s in spans][:2] == ["en", "de"] and abs(spans[0][2] - 60) <= 8


def test_language_model_learns_from_all_documents(spark, monkeypatch):
    draw = random.Random(6)
    letters = {"aa": "abcdef", "bb": "uvwxyzабв"}
    texts = [(lang, " ".join("".join(draw.choices(letters[lang], k=draw.randrange(1, 9))) + draw.choice(["", ",", "7"]) for _ in range(draw.randrange(6))))
             for lang, n in (("aa", 9000), ("bb", 300)) for _ in range(n)]
    texts += [("bb", "z" * 150 + " 12 --"), ("aa", ""), ("aa", None), (None, "abc")]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)], "doc_id long, lang string, text string").repartition(5)
    exact = {lang: np.zeros(language.BUCKETS) for lang in letters}
    for lang, text in texts:
        for word in [w for t in (text or "").split() for w in language.words_of(t)] if lang else ():
            np.add.at(exact[lang], language.features([word])[0], 1)
    for few in (False, True):
        if few:
            monkeypatch.setattr(language, "REMEMBER", 3)
        model = language.fit(frame)
        assert model.languages == ["aa", "bb"]
        for k, lang in enumerate(model.languages):
            grams = exact[lang] + language.SMOOTH
            assert np.array_equal(model.scores[:, k], np.log(grams / grams.sum()).astype(np.float32))
        scripts = [{s for s, fits in zip(language.SCRIPTS, column) if fits} for column in model.allowed.T]
        assert scripts == [{"Latin"}, {"Latin", "Cyrillic"}]


def test_unspaced_languages_are_learned(spark):
    draw = random.Random(6)
    signs = {"zh": [chr(0x4E00 + k) for k in range(0, 300, 3)], "zz": [chr(0x4E00 + k) for k in range(1, 300, 3)], "th": [chr(0x0E01 + k) for k in range(40)]}
    said = {x: ["".join(draw.choice(of) for _ in range(11)) for _ in range(20)] for x, of in signs.items()}
    line = lambda x: "。".join(draw.choice(said[x]) for _ in range(12))
    texts = [(k, line(x), x) for k, x in enumerate([*signs] * 30)]
    assert all(len(language.letters_of(t)) == 132 and len(t.split()) == 1 for _, t, _ in texts)
    out = language.language_table(spark.createDataFrame(texts, "doc_id long, text string, lang string")).filter("held_out").collect()
    assert out and all(r.lang_pred == texts[r.doc_id][2] and r.score == 1 for r in out)
    assert all(r.spans == f'[["{r.lang_pred}", 0, 3]]' for r in out)  # pieces of 64, 64 and 4 letters
    model = language.fit(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    found = language.label([texts[0][1] + " " + texts[2][1], None, texts[0][1]] * 2, language.Scorer(model))
    assert [x[2] for x in found] == [[("zh", 0, 3), ("th", 3, 6)], [], [("zh", 0, 3)]] * 2


def test_viterbi_equals_trying_all_paths():
    draw = np.random.default_rng(1)
    score, of = draw.normal(size=(9, 3)).astype(np.float32) * 2, np.array([0, 4, 4, 9])
    got = language.viterbi(score, of, 1.5)
    value = lambda path, s: sum(s[t, x] for t, x in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
    for a, b in ((0, 4), (4, 9)):
        best = max(value(p, score[a:b]) for p in np.ndindex(*[3] * (b - a)))
        assert math.isclose(value(got[a:b], score[a:b]), best, abs_tol=1e-4)


def test_viterbi_takes_many_languages():
    for languages in (130, 200, 300):
        score = np.zeros((9, languages), np.float32)
        score[:5, languages - 1] = score[5:, languages - 2] = 9
        assert language.viterbi(score, np.array([0, 9])).tolist() == [languages - 1] * 5 + [languages - 2] * 4
    names = [f"l{k:03}" for k in range(200)]
    scores = np.zeros((language.BUCKETS, 200), np.float32)
    scores[:, 150] = 1
    model = language.Model(names, scores, np.ones((len(language.SCRIPTS), 200), bool))
    assert language.label(["one two three"], language.Scorer(model)) == [("l150", 1.0, [("l150", 0, 3)])]


def test_benchmark_passages_are_found(spark, docs):
    frame, items = (spark.read.parquet(str(DATA / f"{n}.parquet")) for n in ("documents", "benchmark"))
    planted = [(r.item_id, r.text) for r in items.collect()]
    hosts = [r.text for r in frame.orderBy("doc_id").limit(len(planted)).collect()]
    more = [(10_000 + k, host + "\n" + text + "\n" + host) for (k, text), host in zip(planted, hosts)]
    whole = frame.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(whole, items).collect()}
    assert len([k for k, _ in planted if (10_000 + k, k) in found]) >= 0.9 * len(planted)
    grams = lambda t: {tuple(t.lower().split()[k : k + 4]) for k in range(len(t.split()) - 3)}
    of = {k: grams(t) for k, t in planted}
    texts = {r.doc_id: grams(r.text) for r in whole.collect()}
    assert all(len(of[i] & texts[d]) >= 0.3 * len(of[i]) for d, i in found)
    for odd in (docs, empty(spark)):
        assert decontaminate.leaks(odd, items).count() == 0
        assert rows(decontaminate.clean(odd, items)) == rows(odd)
    nothing = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    assert decontaminate.leaks(docs, nothing).count() == 0


def test_latent_map_is_fitted_on_all_documents(spark, monkeypatch):
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)]  # fewer than directions, so that the values are exact
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(40))) for _ in range(12_000)] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    idf, *total = decontaminate.inverse_frequencies(frame)
    latent = decontaminate.latent_map(frame, idf, *total)
    hashed = lambda t: [int(h >> np.uint64(20)) % decontaminate.FEATURES for h in words.words(*words.utf8(pa.array([t])), lower=True).hash]
    place = {f: k for k, f in enumerate(sorted({hashed(w)[0] for w in vocabulary}))}
    exact = np.zeros((len(place), len(place)))
    for text in texts:
        own = hashed(text or "")
        for at in range(0, len(own), 16):
            row = np.zeros(len(place))
            for f in own[at : at + 16]:
                row[place[f]] += idf[f]
            exact += np.outer(row, row) / (idf[own[at : at + 16]] ** 2).sum()
    value = 1 / np.linalg.norm(latent / idf[:, None], axis=0)[: len(place)] ** 2
    assert np.allclose(value, np.linalg.eigvalsh(exact)[::-1], rtol=1e-3)
    # several tasks, and one for more words than all
    for size in (1000, 1 << 40):
        monkeypatch.setattr(decontaminate, "PRODUCT_WORDS", size)
        again = decontaminate.latent_map(frame, idf, *total)
        assert np.allclose(again @ again.T, latent @ latent.T, atol=1e-3 * np.abs(latent @ latent.T).max())


def test_parts_of_long_items_are_found(spark):
    frame = spark.read.parquet(str(DATA / "documents.parquet")).select("doc_id", "text")
    hosts = [r.text.split() for r in frame.orderBy("doc_id").collect() if len((r.text or "").split()) > 60][:120]
    draw = random.Random(9)
    words = sorted({w for h in hosts for w in h})
    items = [(k, [draw.choice(words) for _ in range(500 if k % 3 == 2 else 59)]) for k in range(40)]
    cuts = {10_000: lambda t: t[3:43], 20_000: lambda t: t[-28:], 30_000: lambda t: t[20:320]}
    planted = [(base + k, k, cut(t)) for base, cut in cuts.items() for k, t in items if len(t) == 500 or base < 30_000]
    more = [(d, " ".join(hosts[n % 120][:30] + part + hosts[n % 120][30:])) for n, (d, _, part) in enumerate(planted)]
    whole = frame.union(spark.createDataFrame(more, "doc_id long, text string"))
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(whole, benchmark).collect()}
    for base in cuts:
        own = [(d, k) for d, k, _ in planted if base <= d < base + 10_000]
        print(base, len(found & set(own)), len(own))
        assert len(found & set(own)) >= 0.9 * len(own), base
    assert found <= {(d, k) for d, k, _ in planted}


def test_common_subsequence():
    draw = random.Random(2)
    for _ in range(50):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_subsequence(np.array(a), np.array(b)) == best[-1][-1]


PAGES = {
    "<p>a  b<b>c</b><br>d<p>e": "a bc\nd\n\ne",
    "<ul><li>x<li>y<ol start=3><li>p</ol></ul>z": "- x\n- y\n  3. p\n\nz",
    "<table><tr><th>Name<th>N<tr><td>alpha<td>1</table>": "Name   N\nalpha  1",
    "<head><title>t</title></head><div hidden>h</div><p style='display:none'>q</p>ok<script>'</p>'</script>": "ok",
    "<pre> a\n  b</pre>": " a\n  b",
    "x &amp; y < z <!-- no -->": "x & y < z",
    "": "", None: "", "<div" * 3: "<div<div<div", "<p>x" + "<div>" * 20_000 + "deep": "x\n\ndeep",
}


def test_pages_read_as_they_look(spark):
    frame = spark.createDataFrame([(k, None, h, "t") for k, h in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(frame).collect()}
    assert [got[k] for k in range(len(PAGES))] == list(PAGES.values())
    pages = spark.read.parquet(str(DATA / "pages.parquet")).collect()
    for page in pages:  # every visible word, in order
        plain = re.sub(r"<!--.*?-->|<(script|style|head|title)\b.*?</\1>", " ", page.html, flags=re.S)
        words = html_text.unescape(re.sub(r"</?(b|a)\b[^>]*>", "", plain))
        words = re.sub(r"<[^>]+>", " ", words).split()
        assert [w for w in html_text.page_text(page.html).split() if w != "-"] == [w for w in words if w != "-"]


SEEN = {
    '<p title="A hidden gem in Rome">a</p><p aria-label="show hidden text">b': "a\n\nb",
    '<body class="nav hidden md:block"><p style="overflow: hidden ; color:red">a': "a",
    """<p onclick="x.style='display:none'" data-x='visibility:hidden'>a""": "a",
    "<p style=\"content:'; display:none;'; background:url(a;display:none)\">a": "a",
    "<p HIDDEN>a</p><p hidden=hidden>b</p><p class=x hidden/>c</p>d": "d",
    "<p style='Display : None !important; display:block'>a</p><p style='display:none;display:block'>b": "b",
    "<div style='visibility:hidden'>a<b style='visibility: visible'>b</b><hr></div>c": "b\nc",
    "<math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mrow><mi>a</mi><mo>+</mo><mi>b</mi></mrow></mfrac><annotation>t</annotation></math>.": "x=1/(a+b).",
    "<math><msup><mi>x</mi><mn>2</mn></msup><msqrt><mi>y</mi></msqrt></math>": "x^2√y",
    "a <svg><title/><defs><text>no</text></defs><g>no<text x=1>Year</text><text>20<tspan>24</tspan></text></g></svg>b": "a Year 2024 b",
    "<svg width=3><path d='M0'><p>after": "after",
    "<select><option>one<option selected>two</select> <select><option disabled>pick<option>three</select>": "two three",
    "<select multiple><optgroup label=G><option>one<option label=L>two</select>": "G one L",
    "<ol data-start=7><li>x</ol>": "1. x",
}


def test_visible_subtrees_are_kept():
    assert [html_text.page_text(x) for x in SEEN] == list(SEEN.values())


def test_chat_round_trip(spark):
    texts = [None, "", r"\### Assistant: </turn> ok", "a ### b\\h </turn>\n### user:\nx", "é漢🙂 \n\n", "####", "z" * 300_000]
    turns = [(c, t, role, texts[(c + t) % len(texts)]) for c in range(6) for t, role in enumerate(["system", "user", "assistant", "a:b\n", "assistant"])]
    turns += [(None, None, None, "q"), (7, 0, "assistant", "same"), (7, 0, "assistant", "same")]
    frame = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, part long")
    got = {r.conv_id: r for r in chat.chat_table(spark, frame).collect()}
    probe = [(-7, 0, "user", texts[2]), (-7, 1, "assistant", texts[2])]
    by = collections.defaultdict(list)
    for c, t, role, text in [*turns, *probe]:
        by[c].append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, said in by.items():
        loss = "".join(x for _, role, x in said if role == "assistant")
        whole = "".join(f"{role}\n{x}\n" for _, role, x in said)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars) == (len(said), len(loss))
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.formatted(frame.limit(0))).count() == 0


def test_license_notices_in_other_dress(spark, docs):
    texts = ["Copyright 2020 A\n\n" + licenses._ISC.upper() + licenses._AS_IS, "x\nLicenced under CC-BY-NC 4.0!\ny", "under the MIT License."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.license, r.line_licenses, r.n_license_lines) for r in licenses.license_table(frame).collect())
    assert got == [(0, "ISC", "ISC", 1), (1, None, "CC-BY-NC-4.0", 1), (2, None, "", 0)]
    assert licenses.license_table(docs).count() == docs.count() and licenses.license_table(empty(spark)).count() == 0


def test_full_licence_texts_are_known(spark):
    common = Path("/usr/share/common-licenses")
    texts = [(x.stem, x.read_text()) for x in sorted(licenses.TEXTS.glob("*.txt"))]
    texts += [(x, (common / y).read_text()) for x, y in (("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3"), ("MPL-2.0", "MPL-2.0")) if (common / y).exists()]
    body = dict(texts)["BSD-3-Clause"].partition("\n")[2].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    texts += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2021, A. B.\nAll rights reserved.\n" + body)]
    texts += [("GPL-2.0", dict(texts)["GPL-2.0"].partition("END OF TERMS")[0]), ("MPL-2.0", "// SPDX-License-Identifier: MPL-2.0")]
    assert len(texts) >= 20
    frame = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.license_table(frame).collect()}
    assert [got[k] for k in range(len(texts))] == [x.removesuffix("-UC") for x, _ in texts]
    own = spark.createDataFrame([("mine", texts[-1][1])], "license string, text string")
    assert [r.doc_id for r in licenses.license_table(frame, own).filter("license = 'mine'").collect()] == [len(texts) - 1]


def test_language_model_scores(spark, docs):
    out = lm.score_table(docs).collect()
    counts, texts = collections.Counter(), {}
    for r in docs.collect():
        w = [*re.findall(WORD, small(r.text)), None]
        texts.setdefault(r.doc_id, []).append(w)
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10:
            counts.update(w)
    total, distinct = sum(counts.values()), len(counts)
    assert len(out) == docs.count()
    for r in out:
        if r.doc_id is not None:
            w = texts[r.doc_id][0]
            base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), total)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert lm.score_table(empty(spark)).count() == 0


def test_model_beats_the_word_counts(spark):
    out = lm.score_table(spark.read.parquet(str(DATA.parent / "sf0.01" / "documents.parquet")))
    held = out.filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held.s > held.b


def test_gradients_and_probabilities(monkeypatch):
    monkeypatch.setattr(gru, "UNIT", np.float64)
    draw = np.random.default_rng(0)
    counts = np.sort(draw.integers(1, 100, 30))[::-1].astype(float)
    words = gru.Vocabulary(counts, 5)
    p = {k: v.astype(float) for k, v in gru.start(counts, words, 4).items()}
    said, fresh = draw.integers(0, 30, (6, 3)), draw.random((6, 3)) < 0.2
    zero = lambda: {k: np.zeros_like(v) for k, v in p.items()}
    loss = lambda q, grad: gru._window(q, words, np.zeros((3, 4)), said, fresh, grad)[1]
    grad = zero()
    loss(p, grad)
    for k in p:
        at = tuple(draw.integers(0, s) for s in p[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        assert abs((loss(up, zero()) - loss(down, zero())) / 2e-6 - grad[k][at]) < 1e-4
    state = np.ones((1, 4)) * 0.3
    assert math.isclose(sum(math.exp(gru.log_probability(p, words, state, np.array([k]))[0][0]) for k in range(30)), 1)


def test_quality_counts_and_certified_cutoffs(spark, docs):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in quality.quality_table(docs, labels).filter("doc_id is not null").collect():
        text = texts[r.doc_id]
        w = re.findall(WORD, text)
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        twice = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {j for k in range(len(w) - 4) if twice[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and (r.kept or r.failed_rule)
    assert quality.quality_table(empty(spark), labels.limit(0)).count() == 0
    for k, n, p in ((0, 10, 0.2), (3, 20, 0.1)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.binomial_at_most(k, n, p), exact)


def test_cutoffs_are_tested_in_a_fixed_order(spark):
    n, cuts = 1700, len(quality.RULES["short"][1])
    clean = [(k, "en", 100 if k else 28, 400, 0, 1, 0, 0, False) for k in range(n)]
    names = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))
    counted = spark.createDataFrame(clean, names + ", base_failed boolean")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(n)], "doc_id long, quality int, toxic int")
    got = quality.cutoffs(counted, labels).first()
    # one rejection may pass from 1,657 documents on; with a correction for all cutoffs, from 2,243 on
    assert got.clean == n and got.short == quality.RULES["short"][1][0] and got.symbols == quality.RULES["symbols"][1][0]
    row = {"lang": "en", "n": n} | {f"{r}_{k}": 0 for r in quality.RULES for k in range(cuts)} | {"short_5": 90}
    assert quality.certified(quality.pd.DataFrame([row]), 0.004, 0.01)["short"][0] == quality.RULES["short"][1][6]


def test_pipeline_stages_take_awkward_documents(spark, docs, tmp_path):
    spark.read.parquet(str(DATA / "benchmark.parquet")).write.parquet(str(tmp_path / "benchmark.parquet"))
    for frame in (docs, empty(spark)):
        now = frame
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{name}-{frame.count()}")
            stage(spark, now, str(tmp_path)).write.parquet(path)
            before, now = now, spark.read.parquet(path)
            if k < 4:
                assert now.columns == before.columns and now.count() <= before.count()
    assert now.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    other = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        other.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    expected = other.sql(queries.ORACLE_SQL[name])
    columns = sorted(expected.columns)
    got = queries.QUERIES[name](spark, str(DATA)).select(*columns)
    assert rows(got) == sorted(expected.select(*columns).fetchall(), key=repr)
