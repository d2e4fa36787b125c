"""Each operator on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from lauter.llm import language, near_dedup
from lauter.llm.decontaminate import contamination, drop_contaminated
from lauter.llm.exact_dedup import exact_dedup, keep_first_copies
from lauter.llm.html_text import extract, read_page
from lauter.llm.language import label_languages, learnable
from lauter.llm.mixing import mix, take_mix
from lauter.llm.near_dedup import _merged, components, edits_within, keep_one_of_each, near_duplicates, similar
from lauter.llm.suffix_dedup import remove_repeats, suffix_array
from lauter.llm.tokens import token_counts
from lauter.llm.toxicity import drop_toxic, toxicity
from lauter.llm.warc import read_warc, write_warc
from tests.compare import difference, open_tables

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int, size int, key string, h long"


def words(seed, n, pool=4_000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def documents(spark, texts):
    """Extra columns are named as columns inside the operators are."""
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", 1, 2, "k", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    base = words(1, 120)
    near = [*base[:60], "other", *base[61:]]
    return [
        None, "", " ", "!?", "one", "One", " ".join(base), " ".join(base), " ".join(base).upper(), " ".join(near),
        " ".join(words(2, 60)), " ".join(words(3, 50_000)), "ä Ä ß 𝒳 " * 30,
    ]


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_warc", "op8_decontamination"])
def test_same_as_sql(spark, tables, name):
    assert difference(entry.queries()[name](spark, FOLDER), tables, entry.oracle_sql()[name]) is None


# -- 1 ------------------------------------------------------------------------


def test_exact_dedup(spark):
    texts = odd_texts()
    rows = exact_dedup(documents(spark, texts), capacity=2, max_depth=4).collect()
    plain = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    for r in rows:
        same = [i for i, t in enumerate(plain) if t == plain[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))
        assert r.text_sha256 == hashlib.sha256(plain[r.doc_id].encode()).hexdigest()
    assert len(rows) == len(texts)


def test_exact_dedup_tells_colliding_texts_apart(spark):
    from pyspark.sql import functions as F

    rows = exact_dedup(documents(spark, ["a", "b", "A"]), hash_of=lambda c: F.lit(7)).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {0: 2, 1: 1, 2: 2}


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    docs = documents(spark, ["a", "b", None])
    kept = keep_first_copies(docs.unionByName(docs)).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2]
    assert keep_first_copies(docs.where("false")).columns == docs.columns


# -- 2 ------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    given = [(1, "u1", "x"), (2, None, None), (3, "u3", "x"), (4, "u4", "é" * 50_000), (5, "u5", "")]
    write_warc(spark.createDataFrame(given, "page_id long, url string, html string"), str(tmp_path / "w"))
    rows = {r.page_id: r for r in read_warc(spark, str(tmp_path / "w")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in rows.items()} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 1), 4: ("response", None), 5: ("revisit", 2),
    }
    assert rows[4].payload_bytes == 100_000


# -- 3 ------------------------------------------------------------------------


def test_token_counts_are_those_of_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*odd_texts(), "<|endoftext|> a <s> b", "\n" * 5_000, "x" * 30_000, "1234 " * 20_000]
    whole = Tokenizer.from_file(path)
    for r in token_counts(documents(spark, texts), path).collect():
        text = texts[r.doc_id] or ""
        n = len(whole.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


# -- 4 ------------------------------------------------------------------------


def test_html_text_is_the_article(spark):
    found = {r.page_id: r for r in entry.queries()["op4_html_text"](spark, FOLDER).collect()}
    for page in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        text = " ".join(html.unescape(re.sub("<[^>]+>", " ", article)).split())
        assert (found[page.page_id].text, found[page.page_id].n_chars) == (text, len(text))


def test_html_text_of_other_layouts(spark):
    prose = ["".join(f"{w} " for w in words(i, 60)).strip() + "." for i in range(40)]
    plain = "<body><div class='menu'><a href=/>x</a> <a href=/>y</a></div><div>{}</div><div class=sidebar>z</div></body>"
    rows = [(i, "u", plain.format(f"<p>{p}<p>{p} &amp;\n more")) for i, p in enumerate(prose)]
    odd = [(100, None, None), (101, "u", ""), (102, "u", "<"), (103, "u", "<div>" * 3_000), (104, "u", "<script>if (a<b) 1")]
    rows += odd
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, p in enumerate(prose):
        assert found[i] == f"{p} {p} & more"
    assert [found[i] for i in (100, 101, 103, 104)] == ["", "", "", ""]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_are_read_into_blocks():
    page = read_page("<ul><li>a<li>b <b>c</b></ul>d<br>e<style>f</style><p>g<div>h</div>")
    assert [t for _, t in page.pieces] == ["a", "b c", "d e", "g", "h"]


@pytest.mark.parametrize(("page", "pieces"), [
    ("<head><title>T</title><p>a <b>b</b><p>c", ["a b", "c"]),
    ("<html><head><meta charset=utf-8><style>x</style>\n text <i>more</i>", ["text more"]),
    ("<head><script>if (a<b) 1</script><noscript><p>no</p></noscript><link rel=x></head><p>a", ["a"]),
    ("<p>a<svg class=x /> b<p>c<math/>d<svg><path/><g/></svg>e", ["a b", "cde"]),
    ("<svg><svg/>x</svg><p>a", ["a"]),
])
def test_elements_that_html_ends_by_itself(page, pieces):
    assert [t for _, t in read_page(page).pieces] == pieces


# -- 5 ------------------------------------------------------------------------


def labelled(spark):
    texts = [" ".join(words(i, 40) + (["vilest", "scum"] if i % 4 == 0 else [])) for i in range(200)] + [None, ""]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return documents(spark, texts), labels


def test_toxicity(spark):
    docs, labels = labelled(spark)
    rows = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert len(rows) == 202 and all(0 <= r.score <= 1 for r in rows.values())
    assert [i for i, r in rows.items() if i < 200 and r.predicted != (i % 4 == 0)] == []
    assert rows[200].score == rows[201].score < 0.5
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 152
    assert drop_toxic(docs.where("false"), labels).count() == 0
    assert drop_toxic(docs, labels.where("false")).count() == 202


# -- 6 ------------------------------------------------------------------------


def test_mix(spark):
    texts = [" ".join(words(i, 1 + i % 37)) for i in range(600)] + [None, "", " \t"]
    docs = documents(spark, texts)
    rows = mix(docs).collect()
    assert sorted(rows) == sorted(mix(docs).collect()) and len(rows) == len(texts)
    per = defaultdict(list)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").split()) and 0 <= r.taken <= 2 * r.size
        per[r.source].append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(some[0].target for some in per.values()) - 1.5 * total) < 1e-6 * total
    for some in per.values():
        assert abs(sum(r.taken for r in some) - some[0].target) <= 1
    taken = take_mix(docs)
    assert taken.columns == [*(c for c in docs.columns if c != "size"), "size", "source_size", "target", "taken", "copies"]
    assert {r.doc_id: r.taken for r in taken.collect() if r.size} == {r.doc_id: r.taken for r in rows if r.taken}
    assert mix(docs.where("false")).collect() == []


# -- 7 ------------------------------------------------------------------------


def test_near_duplicates(spark):
    rows = {r.doc_id: r for r in near_duplicates(documents(spark, odd_texts())).collect()}
    assert {rows[i].class_id for i in (6, 7, 8, 9)} == {6}
    assert [i for i in (6, 7, 8, 9) if rows[i].kept] == [6]
    assert rows[0].class_id == rows[1].class_id == 0 and rows[3].class_id == 3
    assert all(rows[i].class_size == 1 for i in (10, 11))


def test_one_row_of_each_class_stays(spark):
    docs = documents(spark, odd_texts())
    kept = keep_one_of_each(docs.unionByName(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4, 6, 10, 11, 12]
    assert keep_one_of_each(docs.where("false")).count() == 0


def test_near_duplicates_of_large_buckets_are_those_of_all_pairs(spark):
    """Form letters: all share most shingles, but only two and two of them are a link."""
    rng, template, texts = random.Random(11), words(400, 200), []
    for i in range(100):
        at = rng.sample(range(5, 195, 6), 6)
        for own in (at[2:4], at[4:]):
            text = template[:]
            for place in at[:2]:
                text[place] = f"both{i}"
            for place in own:
                text[place] = f"own{len(texts)}"
            texts.append(" ".join(text))
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if similar(texts[i].encode(), texts[j].encode()):
                low, high = sorted((top(i), top(j)))
                up[high] = low
    rows = {r.doc_id: r.class_id for r in near_duplicates(documents(spark, texts), small=2).collect()}
    assert rows == {i: top(i) for i in range(len(texts))} and len(set(rows.values())) == 100


def test_later_links_join_classes_without_going_over_all_links_again(spark, monkeypatch):
    rng, template, texts = random.Random(12), words(400, 200), []
    for i in range(20):
        at = rng.sample(range(5, 195, 6), 6)
        for own in (at[2:4], at[4:]):
            text = template[:]
            for place in at[:2] + own:
                text[place] = f"one{i}" if place in at[:2] else f"own{len(texts)}"
            texts.append(" ".join(text))
    family = words(300, 200)
    texts += [" ".join([*family, f"copy{i}"]) for i in range(60)]
    sizes = []

    def seen(*args):
        sizes.append(args[-1].count())
        return components(*args)

    monkeypatch.setattr(near_dedup, "components", seen)
    rows = {r.doc_id: r.class_id for r in near_duplicates(documents(spark, texts), small=2).collect()}
    assert rows == {i: i - i % 2 if i < 40 else 40 for i in range(len(texts))}
    assert len(sizes) > 1 and max(sizes[1:]) < sizes[0], sizes


def test_components_of_links_between_classes(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)]
    up = {i: i for pair in links for i in pair}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        up[high] = low
    frame = spark.createDataFrame(links, "left int, right int")
    assert {r.key: r.component for r in components(frame).collect()} == {i: top(i) for i in up}
    assert components(frame.where("false")).count() == 0
    # classes keep their smallest key when a link joins them
    state = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5)], "key int, component int")
    joined = _merged(state, spark.createDataFrame([(3, 1)], "left int, right int"))
    assert {r.key: r.component for r in joined.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}


def test_edits_within():
    def edits(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x):
            last, row[0] = row[0], i + 1
            for j, b in enumerate(y):
                last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (a != b))
        return row[-1]

    rng = random.Random(5)
    for _ in range(500):
        x, y = ("".join(rng.choices("ab", k=rng.randrange(9))) for _ in range(2))
        for most in range(5):
            assert edits_within(x, y, most) == (edits(x, y) <= most), (x, y, most)


# -- 8 ------------------------------------------------------------------------


def test_contamination(spark):
    item = words(8, 15)
    bench = spark.createDataFrame(
        [("a", " ".join(item)), ("b", "Short, one"), ("c", None), (None, "x y"), ("d", "?!"), ("a", " ".join(item))],
        "item_id string, text string",
    )
    texts = [" ".join(words(9, 20) + item), "so: SHORT -- one.", None, "", " ".join(item[:12]), " ".join(words(10, 900)) + " short one"]
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in contamination(docs, bench).collect()}
    assert [(rows[i].n_words, rows[i].n_hit, rows[i]["items"]) for i in range(6)] == [
        (35, 15, ["a"]), (3, 2, ["b"]), (0, 0, []), (0, 0, []), (12, 0, []), (902, 2, ["b"]),
    ]
    assert [rows[i].contaminated for i in range(6)] == [True, True, False, False, False, False]
    assert texts[1][rows[1].spans[0].start : rows[1].spans[0].stop] == "SHORT -- one"
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]
    assert drop_contaminated(docs, bench.where("false")).count() == 6


# -- 9 ------------------------------------------------------------------------


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(400):
        text = [rng.randrange(3) for _ in range(rng.randrange(25))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("hot", [4_000, 3])
def test_removed_bytes_are_those_of_brute_force(spark, hot):
    length = 60
    shared, line = " ".join(words(20, 20)), "again and again ü "
    texts = [" ".join(words(30 + i, 30)) + f" {shared} " + " ".join(words(60 + i, 30)) for i in range(12)]
    texts += [line * 20, line * 9, texts[0], None, "", "short", "short", shared[:59], "z" * 200]
    rows = remove_repeats(documents(spark, texts), length=length, hot=hot).collect()
    data = [(t or "").encode() for t in texts]
    held = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    assert len(rows) == len(texts)
    for r in rows:
        b = data[r.doc_id]
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if held[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(gone), spans), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


# -- 10 -----------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    found = {r.doc_id: r for r in entry.queries()["op10_language_id"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    held = [d for d in docs if found[d.doc_id].held_out and d.lang and re.search(r"[^\W\d_]", d.text or "")]
    right = sum(found[d.doc_id].lang_pred == d.lang for d in held)
    assert held and right >= 0.9 * len(held)


def test_pass_over_words_only_where_a_language_may_switch(monkeypatch):
    draw = np.random.default_rng(5)
    for k in (1, 2, 4):
        lengths = draw.integers(0, 60, 300)
        true = np.repeat(draw.integers(0, k, 300), lengths)
        mixed = np.repeat(draw.random(300) < 0.3, lengths)
        true[mixed] = (true[mixed] + (np.arange(mixed.sum()) // 15)) % k
        scores = draw.normal(-20, 3, (len(true), k))
        scores[np.arange(len(true)), true] += 4
        expected = language.viterbi(scores, lengths, 12.0)
        assert (language.word_labels(scores, lengths, 12.0) == expected).all()
        assert (language.word_labels(scores, lengths, 0.0) == language.viterbi(scores, lengths, 0.0)).all()
        whole = language.whole_language(scores, lengths, 12.0)
        assert ((whole < 0).sum() < 200) and (k == 1 or (whole < 0).any())
    model = language.Model(["a", "b"], np.array([0]), np.zeros((2, 2)), np.ones((len(language.SCRIPT_NAMES), 2), bool))
    sure = np.tile([0.0, -9.0], (3, 1))
    monkeypatch.setattr(language.Model, "scores", lambda *_: sure)
    monkeypatch.setattr(language, "viterbi", lambda *_: pytest.fail("no word is in doubt"))
    names, _, spans = language._labelled(["one two three"], model, language.letter_table(), 12.0)
    assert names.to_pylist() == ["a"]
    assert spans.to_pylist() == [[{"start": 0, "stop": 13, "lang": "a"}]]


def test_languages_of_odd_texts(spark):
    docs = documents(spark, odd_texts())
    rows = {r.doc_id: r for r in label_languages(docs, learnable(docs, "doc_id", 4, 2)).collect()}
    assert len(rows) == docs.count() and all(rows[i].lang_pred == "und" for i in (0, 1, 2, 3))
    assert label_languages(docs.where("false"), docs.where("false")).count() == 0
