"""Parts of the operators against plain versions, and their behaviour under skew."""

import random
import tempfile
from collections import Counter

import brute
import numpy as np
import pytest
from brute import make_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import catalogue, chunked_bpe, contamination, lines, pii, quality, secrets
from tillroll.llm import sharding, simhash, substring
from tillroll.llm.components import components
from tillroll.llm.encoding import Decoder, Encoder
from tillroll.llm.packed import unpack
from tillroll.llm.rolling import Slices, words_of

MESSY = st.text(alphabet="ab' \n\t\r.,AZ09é€😀́  \x1c\x85\x0bßİ", max_size=80)


@pytest.mark.parametrize("path", [catalogue.BYTE_BPE, catalogue.WORD_BPE])
def test_units_give_the_library_s_ids(path):
    coder = Encoder(path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(MESSY, min_size=1, max_size=4))
    def check(texts):
        want = coder.whole(texts)
        assert coder.encode(texts) == want
        assert coder.encode(texts) == want  # from the store

    check()
    special = ["a <|endoftext|> b", "<|startoftext|>x  y", "", " ", "\n", "a ", " a", "a \n b", "a  b"]
    assert coder.encode(special) == coder.whole(special)


@settings(max_examples=150, deadline=None)
@given(st.lists(MESSY, min_size=1, max_size=6))
def test_joined_chunks_are_the_whole(parts):
    coder, words = Encoder(catalogue.BYTE_BPE), Decoder(catalogue.BYTE_BPE)
    whole = np.frombuffer(coder.whole(["".join(parts)])[0], coder.dtype)
    pieces = [np.frombuffer(b, coder.dtype) for b in coder.whole(parts)]
    got = chunked_bpe.joined(pieces, coder, catalogue.BYTE_BPE)
    assert got.tolist() == whole.tolist()
    assert words.text(whole) == "".join(parts)


def test_chunks_are_shared_by_texts_that_share_a_passage():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(4000))
    a, b = (" ".join(word() for _ in range(500)) + " " + passage for _ in range(2))
    own, other = (set(chunked_bpe.chunks(t.encode())) for t in (a, b))
    shared = own & other
    assert sum(map(len, shared)) > 0.8 * len(passage)
    assert b"".join(chunked_bpe.chunks(a.encode())).decode() == a
    emoji = "😀" * 5000
    assert "".join(c.decode() for c in chunked_bpe.chunks(emoji.encode())) == emoji


def test_copies_of_one_text_are_joined_once(spark, tmp_path, monkeypatch):
    """Every text that is joined leaves a file; copies of one text in many tasks leave one."""
    text = " ".join(f"word{i}" for i in range(3000))
    rows = [(i, text) for i in range(40)] + [(None, text), (50, "another"), (51, None)]
    join = chunked_bpe._join_chunks

    def counted(path, with_ids):
        inner, folder = join(path, with_ids), str(tmp_path)

        def run(table):
            out = inner(table)
            for n in out.column("n_tokens").to_pylist():
                if n > 1000:
                    tempfile.mkstemp(dir=folder)
            return out

        return run

    monkeypatch.setattr(chunked_bpe, "_join_chunks", counted)
    docs = make_documents(spark, *rows).repartition(5)
    got = chunked_bpe.encode_decode(docs, catalogue.BYTE_BPE).drop("ids").collect()
    want = brute.bpe_rows(rows)
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert len(list(tmp_path.iterdir())) == 1


@settings(max_examples=400, deadline=None)
@given(st.binary(max_size=14), st.binary(max_size=14), st.integers(0, 3))
def test_banded_edit_distance(a, b, k):
    a, b = (bytes(c % 3 for c in x) for x in (a, b))
    assert lines.within_edits(a, b, k) == (brute.edit_distance(a, b) <= k)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=8, max_size=20), st.lists(st.integers(0, 10**6), max_size=6))
def test_close_lines_share_a_key(text, edits):
    """Whatever two edits do to a line, an index entry of one is probed by the other."""
    changed = text.encode()
    for e in edits[:2]:
        at, how = e % (len(changed) + 1), e % 3
        drop = 0 if how == 0 else 1
        changed = changed[:at] + (b"" if how == 1 else b"z") + changed[at + drop :]
    if len(changed) < 8:
        return
    owner, key, probe = lines.segment_keys([text.encode(), changed], 2, 8)
    entries = [{k for o, k, p in zip(owner, key, probe) if o == i and not p} for i in (0, 1)]
    probes = [{k for o, k, p in zip(owner, key, probe) if o == i} for i in (0, 1)]
    assert entries[0] & probes[1] or entries[1] & probes[0]


def test_hashes_of_slices():
    raw = bytes(random.Random(2).choices(range(256), k=5000))
    s = Slices(raw)
    at = np.array([[a, a + n] for a in range(0, 4000, 7) for n in (1, 9, 60)])
    h = s.hashes(at[:, 0], at[:, 1])
    by_bytes = {}
    for (a, b), x in zip(at.tolist(), h.tolist(), strict=True):
        assert by_bytes.setdefault(raw[a:b], x) == x
    assert len(set(by_bytes.values())) == len(by_bytes)
    assert Slices(raw[100:200]).hashes(np.array([0]), np.array([9])) == s.hashes(
        np.array([100]), np.array([109])
    )


def _clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = centres[rng.integers(0, 40, n)]
    for _ in range(5):
        flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        points = np.where(rng.random(n) < 0.7, points ^ flip, points)
    spread = rng.integers(0, 2**63, n, dtype=np.uint64)
    return np.unique(np.concatenate((points, spread)))


def _brute_labels(points):
    labels = np.arange(len(points))
    return simhash._all_pairs(points, np.arange(len(points)), labels, 2)


def test_tree_search_finds_what_all_pairs_find():
    points = _clustered(3000, 3)
    want = _brute_labels(points)
    for leaf in (16, 200):
        assert (simhash.search(points, 2, leaf) == want).all()
    dense = np.unique(np.random.default_rng(4).integers(0, 2**11, 1800, dtype=np.uint64))
    assert (simhash.search(dense, 2, 64) == _brute_labels(dense)).all()
    every = simhash._common_neighbours(points, np.arange(len(points)), np.arange(len(points)))
    assert (every == want).all()


def test_shards_bring_every_close_pair_together():
    points = _clustered(2000, 5)
    tree = simhash.grow_tree(points[::3], 40, 2)
    shards = {}
    for leaf, places in simhash.leaves_of(tree, points, 2):
        for p in places.tolist():
            shards.setdefault(p, set()).add(leaf)
    assert len({s for own in shards.values() for s in own}) > 10 and len(shards) == len(points)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= 2):
            assert shards[i] & shards[i + 1 + int(j)]


def test_simhash_over_many_shards(spark):
    points = _clustered(3000, 6)
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    tree = simhash.Tree(sample=500, shard_rows=64, leaf_rows=16)
    got = {r.node: r.component for r in components(simhash.fingerprint_links(df, 2, tree)).collect()}
    labels = _brute_labels(points)
    groups = {}
    for i, x in enumerate(labels.tolist()):
        groups.setdefault(x, []).append(int(points.view(np.int64)[i]))
    want = {f: min(g) for g in groups.values() if len(g) > 1 for f in g}
    assert got == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 3000)] + [(1000, 1000)]
    links = spark.createDataFrame(chain + star + [(7000, 6000), (6000, 7000)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {
        **dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 3000), 1000),
        6000: 6000, 7000: 6000,
    }
    assert components(links.limit(0)).count() == 0


def test_a_block_of_a_hot_group_of_lines(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 8)
    rng = random.Random(5)
    rows = []
    for i in range(60):
        chars = list("a common line that many documents have with small changes")
        for _ in range(rng.randint(0, 2)):
            chars[rng.randrange(len(chars))] = rng.choice("xyz")
        rows.append((i, "".join(chars) + "\n" + f"line {i} " + "".join(rng.choices("abcd", k=40))))
    docs = make_documents(spark, *rows)
    got = sorted(tuple(r) for r in lines.count_lines(docs).select("doc_id", "n_lines", "removed").collect())
    assert got == sorted(brute.line_rows(rows))
    monkeypatch.setattr(lines, "FILTER_BITS", 15)  # a bitmap that lets most lines through
    again = lines.count_lines(docs).select("doc_id", "n_lines", "removed")
    assert sorted(tuple(r) for r in again.collect()) == got


def test_super_kmers_cover_every_window_once():
    rng = random.Random(7)
    raw = " ".join(rng.choices(["a", "bb", "ccc", "dd", "e"], k=900)).encode()
    joined, starts, _ = words_of(raw)
    seen = []
    for _, first, words in substring.super_kmers(raw, 50, 8):
        own = words.split(b" ")
        assert joined.split(b" ")[first : first + len(own)] == own
        seen += range(first, first + len(own) - 49)
    assert seen == list(range(len(starts) - 49))


def test_more_hot_minimisers_than_tasks_are_sent(spark, monkeypatch):
    """Which hot minimisers are told apart one by one decides no result."""
    rng = random.Random(14)
    own = lambda n: " ".join("".join(rng.choices("abcdef", k=6)) for _ in range(n))
    passage = own(200)
    rows = [(i, f"{own(20)} {passage} {own(20)}") for i in range(60)]
    docs = make_documents(spark, *rows).repartition(4)
    texts = docs.selectExpr("doc_id", "xxhash64(text) as text_hash", "cast(text as binary) as text")
    monkeypatch.setattr(substring, "HOT", 20)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    want = sorted(brute.substring_rows(rows))
    for most in (2, 1 << 20):
        monkeypatch.setattr(substring, "MOST_HOT", most)
        hot = substring._hot_minimisers(texts, 50, 8).tolist()
        assert hot == sorted(hot) and (len(hot) == 2 if most == 2 else len(hot) > 2)
        got = substring.remove_repeats(docs).select(*names).collect()
        assert sorted(tuple(r) for r in got) == want


def test_substring_of_small_windows(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for i in range(40)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]
    got = substring.remove_repeats(make_documents(spark, *rows), window=5, minimiser=2)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    want = brute.substring_rows(rows, 5)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want)


def test_hot_passage_in_differing_surroundings(spark, monkeypatch):
    """No bucket lays out a hot minimiser; the ranges are those of the plain version."""
    rng = random.Random(13)
    own = lambda n: " ".join("".join(rng.choices("abcdef", k=6)) for _ in range(n))
    passage, copied = own(65), own(120)
    rows = [(i, f"{own(60)} {passage} {own(60)}") for i in range(200)]
    rows += [(200 + i, f"{own(55)} {passage[: rng.randint(280, 400)]} {own(50)}") for i in range(60)]
    rows += [(300 + i, copied) for i in range(60)] + [(None, copied), (400, None)]
    rng.shuffle(rows)
    monkeypatch.setattr(substring, "HOT", 20, raising=False)
    count = substring._count

    def bounded(window):
        inner = count(window)

        def run(table):
            n = Counter()
            for hashes, _, places, *_ in map(unpack, table.column("payload").to_pylist()):
                for h, k in zip(hashes.tolist(), places.tolist(), strict=True):
                    n[h] += k
            assert max(n.values()) <= 30  # 20, and one for each of the tasks that count
            return inner(table)

        return run

    monkeypatch.setattr(substring, "_count", bounded)
    docs = make_documents(spark, *rows).repartition(8)
    got = substring.remove_repeats(docs)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(
        brute.substring_rows(rows), key=key
    )


def test_alignment_against_a_plain_table():
    rng = random.Random(9)
    for _ in range(60):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = max(
                    0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1,
                    table[i][j - 1] - 1,
                )
        got, _ = contamination.align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == max(map(max, table))


def test_edited_copies_are_found_and_clean_texts_are_not(spark):
    """As many matches as aligning every document with every item finds."""
    from tillroll.llm.tables import read_table

    sf = "/root/testdata/sf0.001"
    docs, bench = read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")
    got = {(r.doc_id, r.item_id) for r in contamination.find_contamination(docs, bench).collect()}
    want = set()
    items = [(r.item_id, contamination._words(r.text.encode())) for r in bench.collect()]
    items = [(i, Slices(j).hashes(s, e)) for i, (j, s, e) in items]
    for r in docs.collect():
        joined, starts, ends = contamination._words(r.text.encode())
        words = Slices(joined).hashes(starts, ends)
        for item_id, target in items:
            score, _ = contamination.align(target, words)
            if score >= contamination.LEAST_SCORE * 2 * len(target):
                want.add((r.doc_id, item_id))
    assert got == want and want

    rng = random.Random(10)
    item = bench.orderBy("item_id").first()
    words = item.text.split()
    edited = list(words)
    for k in range(0, len(edited), 9):
        edited[k] = "changed"
    del edited[len(edited) // 2]
    noise = lambda: " ".join("".join(rng.choices("lmnop", k=5)) for _ in range(80))
    rows = [(1, f"{noise()} {' '.join(edited)} {noise()}"), (2, noise()), (3, " ".join(words[:4]))]
    found = contamination.find_contamination(make_documents(spark, *rows), bench).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, item.item_id)]
    assert found[0].score < 1 and found[0].first <= 82 and found[0].stop <= 82 + len(words) + 2


@pytest.mark.parametrize("exact_elsewhere", [False, True])
def test_changed_and_half_copies_have_seeds(spark, exact_elsewhere):
    """No copy that scores enough is missed, however few of its words are left in a row."""
    from tillroll.llm.tables import read_table

    rng = random.Random(12)
    bench = read_table(spark, "/root/testdata/sf0.01", "benchmark").orderBy("item_id").limit(30)
    items = {r.item_id: r.text.split() for r in bench.collect()}
    new = lambda: "".join(rng.choices("lmnop", k=9))
    noise = lambda: [new() for _ in range(40)]
    texts = []
    for words in items.values():
        n = len(words)
        for share in (0.1, 0.2, 0.3):
            changed = set(rng.sample(range(n), round(share * n)))
            texts.append([new() if i in changed else w for i, w in enumerate(words)])
        texts.append([new() if i % 3 == 2 else w for i, w in enumerate(words)])
        texts.append([x for i, w in enumerate(words) for x in ([w, new()] if i % 2 else [w])])
        texts += [words[: n // 2], words[n // 2 :]]
        if exact_elsewhere:
            texts.append(words)
    rows = [(i, " ".join(noise() + t + noise())) for i, t in enumerate(texts)]
    found = contamination.find_contamination(make_documents(spark, *rows), bench).collect()

    def hashed(text):
        joined, starts, ends = contamination._words(text.encode())
        return Slices(joined).hashes(starts, ends)

    targets = {i: hashed(" ".join(words)) for i, words in items.items()}
    want = set()
    for doc_id, text in rows:
        own = hashed(text)
        for item_id, target in targets.items():
            score = contamination.align(target, own)[0] / (2 * len(target))
            if score >= contamination.LEAST_SCORE:
                want.add((doc_id, item_id, round(score, 9)))
    assert want <= {(r.doc_id, r.item_id, round(r.score, 9)) for r in found}
    assert {w[:2] for w in want} == {(r.doc_id, r.item_id) for r in found}


def test_items_of_any_size_are_found_as_by_alignment(spark):
    """Items of 1 to 16 words in random texts of few words: none missed, none besides."""
    rng = random.Random(21)
    word = lambda: rng.choice("abcdefghijkl")
    items = {n * 10 + k: [word() for _ in range(n)] for n in range(1, 17) for k in range(6)}
    rows = []
    for i in range(220):
        text = [word() for _ in range(rng.randint(1, 40))]
        if i % 2:
            copied = list(list(items.values())[i // 2 % len(items)])
            for _ in range(rng.randint(0, 3) if i % 4 == 1 else 0):
                at = rng.randrange(len(copied) + 1)
                copied[at : at + rng.randint(0, 1)] = [word()][: rng.randint(0, 1)]
            text[5:5] = copied
        rows.append((i, " ".join(text)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    found = contamination.find_contamination(make_documents(spark, *rows), bench).collect()

    def hashed(text):
        joined, starts, ends = contamination._words(text.encode())
        return Slices(joined).hashes(starts, ends)

    want, targets = set(), {i: hashed(" ".join(w)) for i, w in items.items()}
    for doc_id, text in rows:
        for item_id, target in targets.items():
            n = len(target)
            least = max(contamination.LEAST_SCORE * 2 * n, 2 * min(n, contamination.LEAST_WORDS))
            if contamination.align(target, hashed(text))[0] >= least - 1e-9:
                want.add((doc_id, item_id))
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert {len(items[i]) for _, i in want} == set(range(1, 17))
    singles = [(r.first, r.stop) for r in found if len(items[r.item_id]) == 1 and r.doc_id == 0]
    assert all(b == a + 1 for a, b in singles)


def test_a_common_phrase_of_a_short_item_is_no_copy(spark):
    bench = spark.createDataFrame([(1, "what is the capital city")], "item_id long, text string")
    rows = [(1, "so this is what is the matter"), (2, "x what is the capital city y"), (3, "what is the capital big city")]
    found = contamination.find_contamination(make_documents(spark, *rows), bench).collect()
    assert [(r.doc_id, r.score, r.first, r.stop) for r in found] == [(2, 1.0, 1, 6)]
    many = make_documents(spark, (1, "what is the capital city " * 20_000))
    assert contamination.find_contamination(many, bench).count() == 20_000


def test_copies_in_one_document_are_told_apart(spark):
    words = [f"word{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    text = ["x"] * 5 + words + ["y"] * 3 + words[:20] + ["z"] * 5
    found = contamination.find_contamination(make_documents(spark, (1, " ".join(text))), bench)
    got = sorted((r.first, r.stop, round(r.score, 3)) for r in found.collect())
    assert got == [(5, 35, 1.0), (38, 58, 0.667)]


def test_learned_rules(spark):
    """Two kinds of bad text; the rules find both and leave good ones alone."""
    rng = random.Random(11)
    good = lambda: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(80))
    rows, labels = [], []
    for i in range(240):
        kind = i % 4
        text = good()
        if kind == 0:
            text = text.upper()
        elif kind == 1:
            text = " ".join(w + "###" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(kind > 1)))
    docs = make_documents(spark, *rows)
    judged = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {(r.doc_id, int(r.kept)) for r in judged.collect()} == set(labels)
    stats = quality.statistics(docs)
    rules = quality.learn(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert rules and all(len(r) <= 3 for r in rules) and "upper_share" in str(rules[0][0]) + str(rules[1][0])
    assert quality.learn(stats, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) == []


def test_many_matches_in_one_text(spark):
    """Places beyond the first block, and a cost that keeps in step with the matches."""
    import re
    import time

    took = {}
    for n in (4_000, 16_000):
        text = " é ".join(f"10.0.{i % 256}.{i % 311}" for i in range(n))
        docs = make_documents(spark, (1, text))
        want = [(m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+){3}", text) if int(m[0].split(".")[3]) < 256]
        start = time.perf_counter()
        [row] = pii.find_pii(docs).collect()
        took[n] = time.perf_counter() - start
        assert [(x.s, x.e) for x in row.base] == want
    assert took[16_000] < 6 * took[4_000] + 1


def test_checksums_and_context(spark):
    texts = {
        "IBAN GB82 WEST 1234 5698 7654 32 is mine": "iban:5:32",
        "IBAN GB82 WEST 1234 5698 7654 33 is wrong": "",
        "IBAN BE68 5390 0754 7034 EUR 20": "iban:5:24",  # a word after it is none of its groups
        "IBAN ES91 2100 0418 4502 0005 1332 BIC X": "iban:5:34",
        "IBAN NO9386011117947 OK": "iban:5:20",
        "IBAN BE68 5390 0754 7034A": "",
        "my SSN 123-45-6789 here": "ssn:7:18",
        "part 123-45-6789 here": "",
        "call 555-123-4567 now": "local_phone:5:17",
        "555-123-4567": "",
        "card 4111111111111111": "card:5:21",
        "card 4111111111111112": "",
        "phone +1 555 123 4567": "phone:6:21",  # the base span stands alone
    }
    rows = list(enumerate(texts))
    got = pii.digest(pii.find_pii(make_documents(spark, *rows))).orderBy("doc_id").collect()
    assert [r.spans for r in got] == list(texts.values())


def test_entropy_and_allow_list(spark):
    value = F.lit("aB3dE6gH9jK2mN5pQ8sT1vW4yZ")
    peak = spark.range(1).select(secrets.peak_entropy(value)).first()[0]
    plain = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ"
    windows = [plain[i : i + 20] for i in range(len(plain) - 19)]
    entropy = lambda w: -sum(w.count(c) / 20 * np.log2(w.count(c) / 20) for c in set(w))
    assert abs(peak - max(map(entropy, windows))) < 1e-9
    texts = {
        f"key {plain} end": "entropy:4:30",
        "xyzxyzxyzxyzxyzxyzxyzxyzxyz1": "",
        "thisisaverylongwordofletters": "",
        "xEXAMPLEx1aB3dE6gH9jK2mN5pQ": "",
        "550e8400-e29b-41d4-a716-446655440000": "",
        f"token={plain}": "assign:0:32",  # inside a base span
    }
    rows = list(enumerate(texts))
    found = secrets.find_secrets(make_documents(spark, *rows))
    got = pii.digest(found, secrets.KINDS, secrets.N_BASE).orderBy("doc_id").collect()
    assert [r.spans for r in got] == list(texts.values())


def test_sharding_splits_only_what_is_too_large(spark):
    rng = random.Random(12)
    rows = [(i, "x" * rng.randint(0, 900)) for i in range(400)]
    rows += [(1000, "y" * 100)] * 50  # one key beyond the limit, whatever its bits
    docs = make_documents(spark, *rows)
    got = sharding.shard(docs, 2000, step=2)
    sizes = sharding.shard_sizes(got).collect()
    assert sum(r.shard_docs for r in sizes) == len(rows)
    assert max(r.shard_bytes for r in sizes) <= 2000
    named = {r.doc_id: r.shard for r in got.collect()}
    bits = {
        r.doc_id: format(r.h, "060b")
        for r in docs.select("doc_id", sharding.hash_bits(F.col("doc_id")).alias("h")).collect()
    }
    total = {}
    for i, t in rows:
        total[i] = total.get(i, 0) + len(t)
    want = brute.shard_names([(i, n) for i, n in total.items() if i != 1000], 2000, bits.__getitem__)
    apart = {i: s for i, s in named.items() if i != 1000}
    # The heavy key only makes its own prefixes heavier.
    heavy = bits[1000]
    assert all(
        s == want[i] or (heavy.startswith(s[: len(want[i])]) and s.startswith(want[i]))
        for i, s in apart.items()
    )
    assert {r.shard.split("-")[0] for r in got.where("doc_id = 1000").collect()} == {heavy}


def test_shards_are_written(spark, tmp_path):
    docs = make_documents(spark, *[(i, "z" * 100) for i in range(50)])
    sharding.write_shards(sharding.shard(docs, 600), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 50 and back.select("shard").distinct().count() > 8


def test_the_bitmap_lets_every_wanted_line_through(spark, monkeypatch):
    """One way at every size: a bitmap too small for its lines costs rows, not results."""
    from tillroll.llm.tables import read_table

    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    want = Counter(tuple(r) for r in lines.count_lines(docs).collect())
    for bits in (15, 20):
        monkeypatch.setattr(lines, "FILTER_BITS", bits)
        assert Counter(tuple(r) for r in lines.count_lines(docs).collect()) == want
    hashes = [0, 1, -1, 5 << 50, -(1 << 63)]
    found = lines._bitmap(spark.createDataFrame([(h,) for h in hashes], "line bigint"))
    at = (np.array(hashes, np.int64).view(np.uint64) >> np.uint64(44)).astype(np.int64)
    assert sorted(np.flatnonzero(np.unpackbits(found, bitorder="little")).tolist()) == sorted(set(at.tolist()))
