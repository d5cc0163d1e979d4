"""The contracts once more, in plain Python, slowly and without Spark."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import types as T
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def make_documents(spark, *rows):
    """A documents table of (doc_id, text) pairs."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENT)


def crowded(docs):
    """The same table with columns named like those that operators work with."""
    from pyspark.sql import functions as F

    names = (
        "tie", "fp", "shard", "row", "key", "id", "_row", "_hash", "_at", "bucket", "payload",
        "places", "words", "lines", "sorted", "starts", "text_hash", "component", "kept", "spans",
        "base", "email", "n_words", "n_bytes", "line", "n", "first", "place",
    )
    return docs.withColumns({n: F.lit("x") for n in names})


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def fingerprint(text, n=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def groups_of(items, linked):
    """Label of each item: the least item reachable through linked pairs."""
    label = {x: x for x in items}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return {x: find(x) for x in items}


def simhash_rows(docs):
    """(doc_id, hex, component_id) of (doc_id, text) rows."""
    fps = [(i, fingerprint(t)) for i, t in docs]
    distinct = sorted({f for _, f in fps})
    arr = np.array(distinct, np.uint64)
    pairs = []
    for k, f in enumerate(distinct):
        near = np.flatnonzero(np.bitwise_count(arr[k + 1 :] ^ np.uint64(f)) <= 2)
        pairs += [(f, distinct[k + 1 + j]) for j in near]
    label = groups_of(distinct, pairs)
    least = {}
    for i, f in fps:
        if i is not None:
            least[label[f]] = min(least.get(label[f], i), i)
    return [(i, f"{f:016x}", least.get(label[f])) for i, f in fps]


def quality_row(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def secret_spans(text):
    text = text or ""
    found = []
    key = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(key, text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            found.append((m.start(), 2, m.end()))
    return sorted(found)


def span_row(spans, kinds):
    """Counts per base kind, and the hash of the spans."""
    text = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
    n = {k: sum(1 for x in spans if x[1] == k) for k in range(len(kinds))}
    return (*n.values(), sha(text))


def substring_rows(docs, window=50):
    """(doc_id, n_words, n_removed, hash of what stays)."""
    first = {}
    for i, t in docs:
        if i is None:
            continue
        w = words(t)
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            first[x] = min(first.get(x, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), sha(kept)))
    return out


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def bpe_rows(docs):
    t = tokenizer("byte_bpe_50k.json")
    out = []
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(back)))
    return out


def token_rows(docs):
    """In ascending doc_id order: (doc_id, start, n_tokens, crc32)."""
    t = tokenizer("word_bpe_49k.json")
    out, start = [], 0
    for i, text in sorted(docs, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def far_apart(a, b, limit):
    """Certainly more than ``limit`` edits, by how often each byte occurs."""
    difference = Counter(a)
    difference.subtract(b)
    more = sum(v for v in difference.values() if v > 0)
    less = -sum(v for v in difference.values() if v < 0)
    return max(more, less) > limit


def line_rows(docs, max_edits=2, least=32):
    """(doc_id, n_lines, removed numbers) of (doc_id, text) rows."""
    where = defaultdict(list)
    n = {}
    for r, (i, t) in enumerate(docs):
        n[r] = 0
        for k, x in enumerate((t or "").split("\n")):
            if s := x.strip(" \t\n\x0b\f\r"):
                n[r] += 1
                where[s.encode()].append(((i is None, i or 0), r, k))
    long = sorted((x for x in where if len(x) >= least), key=len)
    pairs = []
    for a, x in enumerate(long):
        for y in long[a + 1 :]:
            if len(y) - len(x) > max_edits:
                break
            if not far_apart(x, y, max_edits) and edit_distance(x, y) <= max_edits:
                pairs.append((x, y))
    label = groups_of(where, pairs)
    classes = defaultdict(list)
    for x, places in where.items():
        classes[label[x]] += places
    gone = defaultdict(list)
    for places in classes.values():
        for _, r, k in sorted(places)[1:]:
            gone[r].append(k)
    return [(docs[r][0], n[r], ",".join(map(str, sorted(gone[r])))) for r in range(len(docs))]


def shard_names(sizes, limit, bits):
    """{doc_id: shard} by splitting buckets one by one; ``bits`` gives 60 bits as text."""
    out = {}

    def place(prefix, members):
        if sum(n for _, n in members) <= limit:
            out.update({i: prefix for i, _ in members})
            return
        for b in "01":
            part = [(i, n) for i, n in members if bits(i)[len(prefix)] == b]
            if part:
                place(prefix + b, part)

    place("", sizes)
    return out


def tree_rows(docs):
    """(doc_id, n_tokens, hash of decimal ids, hash of the bytes) by the library on whole texts."""
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    coder = tiktoken.Encoding(
        "brute", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    out = []
    for i, text in docs:
        ids = coder.encode_ordinary(text or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(coder.decode_bytes(ids))))
    return out


def token_bytes():
    """What both tokenizers give for a text: [(id, bytes)] each."""
    import sentencepiece

    a = tokenizer("byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in printable]
    letters = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(rest)}

    def of_b(i):
        piece = b.id_to_piece(i)
        hexa = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(hexa[1], 16)]) if hexa else piece.replace("▁", " ").encode()

    def cut(text):
        if not text:
            return [], []
        left = [
            (i, bytes(letters[c] for c in a.id_to_token(i)))
            for i in a.encode(" " + text, add_special_tokens=False).ids
        ]
        right = [(i, of_b(i)) for i in b.encode(text)]
        for side in (left, right):
            if b"".join(raw for _, raw in side) != (" " + text).encode():
                return [], []
        return left, right

    return cut


def alignment_rows(docs):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, hash) of (doc_id, text) rows."""
    cut, every, counts, per_b = token_bytes(), [], Counter(), Counter()
    for i, text in docs:
        a, b = cut(text)
        ranges = []
        for side in (a, b):
            at, spans = 0, []
            for token, raw in side:
                spans.append((token, at, at + len(raw)))
                at += len(raw)
            ranges.append(spans)
        links, first = [], 0
        for x, begin, end in ranges[0]:
            while first < len(ranges[1]) and ranges[1][first][2] <= begin:
                first += 1
            k = first
            while k < len(ranges[1]) and ranges[1][k][1] < end:
                links.append((x, ranges[1][k][0]))
                k += 1
        ends = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups, at = [], [0, 0]
        for end in ends:
            sides = [[], []]
            for k, r in enumerate(ranges):
                while at[k] < len(r) and r[at[k]][2] <= end:
                    sides[k].append(str(r[at[k]][0]))
                    at[k] += 1
            groups.append("|".join(map(",".join, sides)))
        counts.update(links)
        every.append((i, len(a), len(b), len(ends), links, ";".join(groups)))
    for (_, y), n in counts.items():
        per_b[y] = max(per_b[y], n)
    return [
        (
            i, n_a, n_b, n_groups, len(links),
            sum(counts[x] == per_b[x[1]] for x in links),
            sum(counts[x] for x in links),
            sha(groups) if n_a else "",
        )
        for i, n_a, n_b, n_groups, links, groups in every
    ]


def divergence_rows(docs, least_docs=10):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
        counts[lang or "", source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = []
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least_docs]
        sources = [s for x, s in counts if x == lang]

        def shares(of, kept=kept):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])
        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        apart = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(sum(apart(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            own = [t for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            terms = [(apart(p[s][t], q[t]), t) for t in own]
            for part, rows, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:most]
                out += [(lang, s, part, x, v, k + 1) for k, (v, x) in enumerate(ranked)]
    return out


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def quality_features(text):
    text = text or ""
    n, chars, symbols, dup, repeated, _ = quality_row(text)
    n_lines = sum(bool(words(line)) for line in text.split("\n"))
    count = lambda pattern: len(re.findall(pattern, text))
    share = lambda a, b: a / b if b else 0.0
    return {
        "repeat_share": share(repeated, n),
        "symbols_per_word": share(symbols, n),
        "dup_line_share": share(dup, n_lines),
        "word_length": share(chars, n),
        "upper_share": share(count("[A-Z]"), chars),
        "digit_share": share(count("[0-9]"), chars),
        "marks_per_word": share(count(r"""[!?;:"'()\[\]{}/\\~^_=+@`]"""), n),
        "words_per_line": share(n, n_lines),
    }


def _holds(rule, values):
    return all((values[f] > t) == above for f, above, t in rule)


def quality_rules(docs, labels):
    """Ordered rules, each a list of (feature, above, threshold), by sequential covering."""
    bad = {}
    for i, quality in labels:
        if i is not None and quality is not None:
            bad[i] = bad.get(i, False) or quality == 0
    known = [(i, quality_features(t), bad[i]) for i, t in docs if i in bad and not quality_row(t)[-1]]
    if len({b for _, _, b in known}) < 2:
        return []
    cuts = {}
    for f in known[0][1]:
        cuts[f] = set()
        for kind in (True, False):
            values = sorted(v[f] for _, v, b in known if b == kind)
            for k in range(25):
                cuts[f].add(values[max(math.ceil(k / 24 * len(values)) - 1, 0)])
    third = lambda i: _signed(xxhash.xxh64_intdigest(struct.pack("<q", i), 42)) % 3 == 0
    growing = [(v, b) for i, v, b in known if not third(i)]
    pruning = [(v, b) for i, v, b in known if third(i)]
    rules = []
    while len(rules) < 8:
        now, grown = growing, []
        while len(grown) < 3:
            bad0, best = sum(b for _, b in now), (1e-9, None)
            for f, own in cuts.items():
                for cut in sorted(own):
                    for above in (False, True):
                        left = [b for v, b in now if (v[f] > cut) == above]
                        n_bad = sum(left)
                        if n_bad:
                            before, after = bad0 / len(now), n_bad / len(left)
                            gain = n_bad * (math.log2(after) - math.log2(before))
                            if gain > best[0] + 1e-9:
                                best = (gain, (f, above, cut))
            if best[1] is None:
                break
            f, above, cut = best[1]
            low = max(v[f] for v, _ in now if v[f] <= cut)
            high = min(v[f] for v, _ in now if v[f] > cut)
            grown.append((f, above, (low + high) / 2))
            now = [(v, b) for v, b in now if _holds(grown[-1:], v)]
            if all(b for _, b in now):
                break
        best = (0.0, [])
        for k in range(1, len(grown) + 1):
            got = [b for v, b in pruning if _holds(grown[:k], v)]
            n, n_bad, share = len(got), sum(got), sum(b for _, b in pruning) / max(len(pruning), 1)
            if not n_bad or n_bad < 0.95 * n or n_bad / n <= share:
                continue
            told = n_bad * math.log(n_bad / n / share)
            if n > n_bad:
                told += (n - n_bad) * math.log((n - n_bad) / n / (1 - share))
            if math.exp(-told) <= 0.001 and (n_bad + 0.5) / (n + 1) > best[0]:
                best = ((n_bad + 0.5) / (n + 1), grown[:k])
        if not best[1]:
            break
        rules.append(best[1])
        growing, pruning = ([r for r in rows if not _holds(best[1], r[0])] for rows in (growing, pruning))
    return rules


def quality_verdicts(docs, labels):
    """(doc_id, kept, number of the rule that rejects it)."""
    rules = quality_rules(docs, labels)
    out = []
    for i, text in docs:
        values = quality_features(text)
        rule = next((k for k, r in enumerate(rules) if _holds(r, values)), None)
        out.append((i, rule is None and not quality_row(text)[-1], rule))
    return out
