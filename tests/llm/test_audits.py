"""Source divergence, fingerprints and the conversation trie against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from lauter.llm import divergence, fingerprint
from lauter.llm.divergence import source_divergence
from lauter.llm.fingerprint import edited, fingerprint_documents, fingerprints, likeness, neighbour_likeness
from lauter.llm.prefix_trie import common_turns, conversations, prefix_trie, with_shared_heads
from tests.compare import difference, open_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_prefix_trie"])
def test_same_as_sql(spark, tables, name):
    assert difference(entry.queries()[name](spark, FOLDER), tables, entry.oracle_sql()[name]) is None


# -- source divergence ----------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def divergence_by_hand(rows, keep=3, top=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    for lang, source, text in rows:
        found = terms_of(text)
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= keep]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(counter, kept=kept):
            whole = sum(counter[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // whole for t in kept}

        own = {s: shares(counts[lang, s]) for s in sources}
        total = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            p = own[s]
            pairs = [(o, sum((p[t] - own[o][t]) ** 2 // own[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[t] - total[t]) ** 2 // total[t]) for t in kept if counts[lang, s][t] and p[t] > total[t]]
            for part, values in (("pair", pairs), ("term", terms)):
                values.sort(key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, s, part, *v, i) for i, v in enumerate(values, 1) if part == "pair" or i <= top]
    return sorted(out)


def divergence_rows(rng, n):
    pool = ["a", "Bee", "cee", "sevenxx", "eighteen", "ninechars", "sixteen-letters", "abcdefghijklmnop", "abcdefghijklmnopq"]
    pool += ["z" * 33, "z" * 34, "straße", "漢字かな", "É", "é", "don't", "a_b", "x1y"]
    return [
        (rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "s2", None]),
         " ".join(rng.choices(pool, weights=range(len(pool), 0, -1), k=rng.randrange(25))))
        for _ in range(n)
    ]


DIVERGENCE = "lang string, source string, text string, n long, term string, no int"


def divergence_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DIVERGENCE)


def collected(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_divergence_by_hand(spark):
    rows = [*divergence_rows(random.Random(5), 120), (None, None, None), ("xx", "only", ""), ("xx", "other", None)]
    rows += [("yy", "s", "once twice")] * 3  # repeated rows are documents
    found = source_divergence(divergence_frame(spark, rows))
    assert collected(found) == divergence_by_hand(rows)
    assert {(r[0], r[1], r[4]) for r in collected(found) if r[0] == "xx"} == {("xx", "only", 0), ("xx", "other", 0)}


def test_divergence_small_slices(spark, monkeypatch):
    """A text beyond a slice is counted window by window, pairs in several chunks."""
    monkeypatch.setattr(divergence, "SLICE", 64)
    monkeypatch.setattr(divergence, "PAIRS", 5)
    rows = [*divergence_rows(random.Random(6), 80), ("en", "s1", "long " * 200 + "z" * 500)]
    rows += [("en", f"s{i}", "shared words here") for i in range(9)]
    assert collected(source_divergence(divergence_frame(spark, rows), top=3)) == divergence_by_hand(rows, top=3)


def test_divergence_of_nothing(spark):
    assert source_divergence(divergence_frame(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZ é漢.0'"), max_size=60), min_size=1, max_size=6))
def test_terms_are_packed_and_counted(texts):
    import pyarrow as pa

    data, offsets = divergence._buffer(pa.array(texts, pa.string()))
    start, length, text = divergence.term_spans(data, offsets)
    found = {}
    for s, n, g, times, docs in divergence.term_runs(data, start, length, text % 2, text):
        for row in zip(s, n, g, times, docs, strict=True):
            found[int(row[2]), data[row[0] : row[0] + row[1]].tobytes().decode()] = (int(row[3]), int(row[4]))
    expected = defaultdict(lambda: [0, 0])
    for i, t in enumerate(texts):
        for term, n in Counter(terms_of(t)).items():
            expected[i % 2, term][0] += n
            expected[i % 2, term][1] += 1
    assert found == {k: tuple(v) for k, v in expected.items()}


def test_shares_beyond_32_bits(spark):
    from pyspark.sql import functions as F

    cases = [(0, 0, 1), (10**15, 8 * 10**15, 10**12), (10**6, 10**6, 1), (123_456_789, 987_654_321_000, 77_777)]
    frame = spark.createDataFrame(cases, "c long, n long, v long")
    found = frame.select("c", "n", "v", divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["c"] + 1) // (r["n"] + r["v"]) for r in found)


# -- fingerprints ----------------------------------------------------------------


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(n))


def test_equal_texts_equal_fingerprints_in_any_company():
    texts = ["", "a", "aa", "ab", "aaaaaaa" * 50, prose(1, 5), prose(2, 60), prose(3, 3_000), "🙂ü" * 40, prose(2, 60)]
    together = fingerprints(texts)
    assert together == [fingerprints([t])[0] for t in texts]
    assert together == fingerprints(texts[::-1])[::-1]
    assert len(set(together)) == len(set(texts))


def test_steps_change_nothing(monkeypatch):
    texts = [prose(1, 700), "x" * 500, prose(4, 30)]
    whole = fingerprints(texts)
    monkeypatch.setattr(fingerprint, "STEP", 17)
    assert fingerprints(texts) == whole


@settings(max_examples=40, deadline=None)
@given(st.text("abc ", max_size=80), st.text("abc ", max_size=80), st.integers(0, 10_000))
def test_equal_substrings_share_interior_phrases(left, right, seed):
    """All but a few phrases at the ends of a common substring are the same."""
    core = prose(seed, 200)

    def phrases(text):
        names = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        first = np.zeros(len(names), bool)
        first[0] = True
        out = []
        for _ in range(2):
            names, first = fingerprint.parse(names, first)
            out.append(Counter(names.tolist()))
        return out

    for alone, inside, lost in zip(phrases(core), phrases(left + core + right), (8, 12), strict=True):
        assert sum((alone - inside).values()) <= lost


def test_phrases_are_short():
    for text in (prose(9, 2_000), "ab" * 999, "abc" * 500, "".join(map(chr, range(33, 3_000)))):
        names = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        first = np.zeros(len(names), bool)
        first[0] = True
        names, first = fingerprint.collapse(names, first)
        size = np.diff(np.append(np.flatnonzero(fingerprint.phrase_starts(names, first)), len(names)))
        assert size.min() >= 2 and size.max() <= 13


def test_likeness_estimates_common_phrases():
    for seed in range(20):
        base = prose(seed, 300)
        other = prose(seed + 1_000, 300)
        marks = fingerprints([base, edited(base, other), other, base + " tail"])
        assert 0.3 < likeness(marks[0], marks[1]) < 0.75
        assert likeness(marks[0], marks[2]) < 0.05
        assert likeness(marks[0], marks[3]) > 0.9
        assert likeness(marks[0], marks[0]) == 1.0
    assert likeness(*fingerprints(["", ""])) == 1.0
    assert likeness(*fingerprints(["", "a"])) == 0.0


DOCS = "doc_id long, text string, part long, head boolean, fingerprint string"


def neighbours_by_hand(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [r[1] or "" for r in ordered]
    out = []
    for i, (identity, _) in enumerate(ordered):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        change = edited(text, after)
        a, b, c = (fingerprints([t])[0] for t in (text, change, after))
        sha = hashlib.sha256(change.encode()).hexdigest()
        out.append((identity, len(text), sha, a, b, likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 90])
def test_neighbours_by_hand(spark, size):
    rows = [(i * 7 % 101, prose(i, i % 40) if i % 5 else None) for i in range(size)]
    rows += [(None, "no id")] if size > 3 else []
    rows += [(500, prose(8, 20_000)), (501, "")] if size > 3 else []
    frame = spark.createDataFrame([(*r, 1, True, "f") for r in rows], DOCS).repartition(4)
    found = sorted((tuple(r) for r in neighbour_likeness(frame).collect()), key=str)
    assert found == neighbours_by_hand(rows)


def test_neighbours_small_portions(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "TOGETHER", 50)
    rows = [(i, prose(i, i % 30)) for i in range(60)]
    frame = spark.createDataFrame([(*r, 1, True, "f") for r in rows], DOCS)
    assert sorted((tuple(r) for r in neighbour_likeness(frame).collect()), key=str) == neighbours_by_hand(rows)


def test_neighbours_ties_and_nothing(spark):
    rows = [(1, "one two three")] * 5 + [(1, "another text"), (2, "last")]
    frame = spark.createDataFrame([(*r, 1, True, "f") for r in rows], DOCS)
    found = neighbour_likeness(frame).collect()
    assert len(found) == 7 and sum(r["near_next"] == 1.0 for r in found) >= 4
    assert collected(neighbour_likeness(frame)) == collected(neighbour_likeness(frame.repartition(3)))
    assert neighbour_likeness(frame.where("false")).collect() == []
    assert fingerprint_documents(frame.where("false")).collect() == []


def test_every_document_has_a_fingerprint(spark):
    frame = spark.createDataFrame([(1, None, 1, True, "f"), (2, "some text", 1, True, "f")], DOCS)
    found = collected(fingerprint_documents(frame))
    assert found == [(1, 0, ""), (2, 9, fingerprints(["some text"])[0])]


# -- prefix trie -----------------------------------------------------------------


def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), digest[:16], role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
            if d:
                children[rebuilt[: d - 1]].add(rebuilt[:d])
        ends[rebuilt].append(c)

    def below(node):
        stack, leaves, saved = [node], 0, 0
        while stack:
            at = stack.pop()
            leaves += not children[at]
            saved += (len(members[at]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", at[-1][1])) if at else 0)
            stack += children[at]
        return leaves, saved

    return sorted(
        (
            (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), *below(n),
             hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
            for n, m in list(members.items())
        ),
        key=str,
    )


def chats(seed, n, most=6):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", None])
            text = rng.choice(["hi there", "hi there", "hi there", "so", "", None, "a b c d"])
            rows.append((c, t if rng.random() < 0.9 else None, role, text))
    return rows


TURNS = "conv_id long, turn long, role string, text string, key string, seq string, n long"


def trie(spark, rows, **blocks):
    frame = spark.createDataFrame([(*r, "k", "s", 1) for r in rows], TURNS).repartition(3)
    built = with_shared_heads(conversations(frame))
    return sorted((tuple(r) for r in prefix_trie(built, **blocks).collect()), key=str)


@pytest.mark.parametrize("rows", [1, 2, 5, 1 << 16])
def test_trie_by_hand(spark, rows):
    """Small blocks: most nodes lie in several of them."""
    data = chats(3, 150)
    assert trie(spark, data, block_rows=rows) == trie_by_hand(data)


def test_trie_of_odd_tables(spark):
    deep = [(21, i, "user", f"turn {i}") for i in range(300)] + [(22, i, "user", f"turn {i}") for i in range(280)]
    data = [*deep, (None, 1, "user", "nobody"), (-25, 1, "user", "x"), (40, 1, None, None), (41, None, "", "")]
    data += [(60, 1, "u", "same"), (60, 1, "u", "same")]  # repeated rows are turns
    data += [(1_000 + i, t, "user", f"copy {t}") for i in range(50) for t in range(2)]
    assert trie(spark, data, block_turns=100) == trie_by_hand(data)
    assert trie(spark, []) == []


def test_ids_of_copies_are_cut_into_pieces(spark, monkeypatch):
    from lauter.llm import prefix_trie as module

    monkeypatch.setattr(module, "PIECE", 7)
    data = [(i, 0, "user", "the same") for i in range(0, 2_000, 20)]
    assert trie(spark, data) == trie_by_hand(data)


def test_common_turns():
    seqs = sorted([b"", b"a" * 16, b"a" * 32, b"a" * 16 + b"b" * 16, b"c" * 48, b"c" * 64])
    offsets = np.concatenate([[0], np.cumsum([len(s) // 16 for s in seqs])])
    digests = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    assert common_turns(digests, offsets).tolist() == [0, 0, 1, 1, 0, 3]
