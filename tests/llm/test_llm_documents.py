"""Operators over documents: brute-force comparisons and odd rows."""

from __future__ import annotations

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from kalendra.llm import (
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secrets,
    token_file,
)
from kalendra.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [
    (1, None, "en", "a", 1), (2, "", None, None, 2), (3, " \n\t ", "en", "a", None),
    (4, "one", "en", None, 3), (5, LONG, None, "b", 4), (5, LONG, None, "b", 4),
    (None, "some text without a number", "en", "a", 5), (None, None, None, None, None),
    (6, "1234 5678", "de", "c", 6), (7, "!!! ???", "de", "", 7),
]


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in ("kept", "size", "root", "node", "id", "score", "language", "b", "part", "n", "target"):
            df = df.withColumn(name, F.lit("x"))
    return df


OPERATORS = {
    "near": near_dedup.near_dups,
    "near drop": near_dedup.drop_near_dups,
    "language": language_id.identify,
    "language keep": language_id.keep_identified,
    "mix": mixing.mix,
    "mix documents": mixing.mixed_documents,
    "lines": line_dedup.repeated_lines,
    "lines out": line_dedup.without_repeats,
    "quality": quality.judged,
    "secrets": secrets.scan,
    "licences": licenses.scan,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_empty_tables(spark, name):
    run = OPERATORS[name]
    odd = run(frame(spark, ODD, clash=True))
    none = run(frame(spark, [], clash=True))
    rows = odd.collect()
    assert none.columns == odd.columns and none.count() == 0
    if name in ("near", "language", "mix", "quality"):
        assert len(rows) == len(ODD)
    if name.split()[-1] in ("drop", "keep", "documents", "out"):
        assert odd.columns == frame(spark, [], clash=True).columns


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(45)]
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame([*edges, (None, 1)], "a long, b long"), "a", "b")
    assert {r.node: r.root for r in found.collect()} == {
        x: find(x) for e in edges if e[0] != e[1] for x in e
    }


def test_near_dups_against_all_pairs(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, k = [], 0
    for size in (30, 60, 120, 9, 4):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, size // 30) + 2)):
                words[rng.randrange(size)] = rng.choice(vocabulary)
            text = " ".join(words)
            rows.append((k, text.upper() if rng.random() < 0.2 else text, "en", "a", 0))
            k += 1
    rows.append((k, None, "en", "a", 0))
    sets = {}
    for d, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for parts in (near_dedup.PART_MEMBERS, 16):
        near_dedup.PART_MEMBERS, before = parts, near_dedup.PART_MEMBERS
        found = near_dedup.near_dups(frame(spark, rows)).collect()
        near_dedup.PART_MEMBERS = before
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
            d: (len(sets[d]), find(d), find(d) == d) for d in sets
        }


def test_language_held_out_accuracy(spark):
    rng = random.Random(4)
    kinds = {"aa": "abcde", "bb": "efghi", "cc": "ijklm"}
    rows = []
    for d in range(300):
        lang = rng.choice(sorted(kinds))
        text = " ".join("".join(rng.choice(kinds[lang]) for _ in range(5)) for _ in range(30))
        rows.append((d, text, lang if d % 7 else None, "s", 0))
    truth = {d: text for d, text, *_ in rows}
    found = language_id.identify(frame(spark, [*rows, (900, "12 34", "aa", "s", 0)])).collect()
    right = [
        set(truth[r.doc_id]) <= set(kinds[r.lang_pred] + " ") for r in found if r.held_out and r.doc_id < 900
    ]
    assert sum(right) >= 0.95 * len(right) > 30
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    assert [(r.lang_pred, r.score) for r in found if r.doc_id == 900] == [("und", 0.0)]


def test_nothing_to_learn(spark):
    rows = [(d, "some text", None, "s", 0) for d in range(5)]
    assert {r.lang_pred for r in language_id.identify(frame(spark, rows)).collect()} == {"und"}


def test_mixing(spark):
    rng = random.Random(6)
    sizes = {"a": 40, "b": 5, "c": 60, None: 30}
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["x"] * rng.randrange(0, 60)) + " \n", "en", source, 0))
    for threshold in (mixing.RANK_PARTS, 2):
        mixing.RANK_PARTS, before = threshold, mixing.RANK_PARTS
        found = mixing.mix(frame(spark, rows)).collect()
        copies = mixing.mixed_documents(frame(spark, rows)).groupBy("doc_id").count().collect()
        mixing.RANK_PARTS = before
        count = {r["doc_id"]: r["count"] for r in copies}
        source = {r[0]: r[3] for r in rows}
        total = {s: sum(r.size for r in found if source[r.doc_id] == s) for s in sizes}
        weights = dict(zip(("a", "b", "c", None), (1, 2, 3, 1), strict=True))
        left, share, open_ = sum(total.values()), {}, set(sizes)
        while open_:
            part = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
            over = {s for s in open_ if part[s] >= 3 * total[s]}
            if not over:
                share |= part
                break
            share |= {s: 3 * total[s] for s in over}
            left -= sum(3 * total[s] for s in over)
            open_ -= over
        for s in sizes:
            own = [r for r in found if source[r.doc_id] == s]
            assert all(r.source_size == total[s] and abs(r.target - share[s]) < 1e-6 for r in own)
            assert abs(sum(r.taken for r in own) - share[s]) <= 2
            assert all(r.taken <= 3 * r.size for r in own)
        assert count == {r.doc_id: r.taken // r.size for r in found if r.taken}


def test_plan_meets_budgets():
    rng = random.Random(2)
    for _ in range(200):
        sizes = rng.sample(range(1, 50), rng.randrange(1, 8))
        counts = [rng.randrange(1, 6) for _ in sizes]
        budget = rng.randrange(0, sum(s * c for s, c in zip(sizes, counts, strict=True)) + 1)
        taken = mixing.plan(sizes, counts, budget)
        assert all(0 <= k <= c for k, c in zip(taken, counts, strict=True))
        got = sum(s * k for s, k in zip(sizes, taken, strict=True))
        assert got <= budget and budget - got < max(sizes)


def test_fill_is_the_best_sum():
    rng = random.Random(3)
    for _ in range(100):
        sizes = sorted(rng.sample(range(1, 20), 3), reverse=True)
        counts = [rng.randrange(0, 4) for _ in sizes]
        budget = rng.randrange(0, 60)
        taken = mixing._fill(sizes, counts, budget)
        sums = {a * sizes[0] + b * sizes[1] + c * sizes[2]
                for a in range(counts[0] + 1) for b in range(counts[1] + 1) for c in range(counts[2] + 1)}
        assert sum(s * k for s, k in zip(sizes, taken, strict=True)) == max(x for x in sums if x <= budget)
        assert all(k <= c for k, c in zip(taken, counts, strict=True))


def test_contaminated(spark):
    rng = random.Random(9)
    words = [f"k{i}" for i in range(3000)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, text(30).capitalize() + ".") for i in range(20)] + [(50, None), (51, ""), (52, "two words"), (None, text(20))]
    rows, expected = [], set()
    for d in range(60):
        body = text(100)
        if d % 3 == 0:
            i = d % 20
            item = items[i][1].lower().rstrip(".").split()
            if d % 2:
                item = [w if k % 6 else "changed" for k, w in enumerate(item)]
                del item[10]
            body = f"{body}, {' '.join(item)}! {text(30)}"
            expected.add((d, i))
        elif d % 3 == 1:
            body += " " + " ".join(items[d % 20][1].split()[:6])  # a short overlap is no copy
        rows.append((d, body, "en", "s", 0))
    rows += [(x[0] and x[0] + 1000, *x[1:]) for x in ODD]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    found = decontaminate.contaminated(frame(spark, rows, clash=True), bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    kept = decontaminate.drop_contaminated(frame(spark, rows), bench)
    assert kept.count() == len(rows) - len(expected)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(frame(spark, rows), empty).count() == 0
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0


def test_alignment_against_a_full_table():
    import numpy as np

    rng = random.Random(1)
    for _ in range(50):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        b = [rng.randrange(5) for _ in range(rng.randrange(1, 20))]
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (1 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.align(np.array(a), np.array(b))[0] == h.max()


def test_repeated_lines_against_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 8))] for _ in range(40)]

    def edited(line):
        line, kind, i = list(line), rng.randrange(3), rng.randrange(len(line))
        if kind == 0:
            line[i] = rng.choice(vocabulary)
        elif kind == 1:
            del line[i]
        else:
            line.insert(i, rng.choice(vocabulary))
        return line

    docs = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line = edited(line) if line else line
            lines.append("  ".join(line))
        docs.append((d, "\n".join(lines), "en", "s", 0))
    docs += [(None, "a b", "en", "s", 0), (100, None, "en", "s", 0), (102, "\n \n", "en", "s", 0)]
    rng.shuffle(docs)

    def edits(a, b):
        if a == b:
            return 0
        if min(len(a), len(b)) < line_dedup.LEAST_WORDS or abs(len(a) - len(b)) > 1:
            return 9
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True))
        a, b = sorted((a, b), key=len)
        return 1 if any(b[:i] + b[i + 1 :] == a for i in range(len(b))) else 9

    lines = sorted(
        (d, i, x.split()) for d, t, *_ in docs if d is not None and t
        for i, x in enumerate(t.split("\n")) if x.split()
    )
    expected = {}
    for k, (d, i, line) in enumerate(lines):
        like = next(((e, j, edits(line, m)) for e, j, m in lines[:k] if edits(line, m) <= 1), None)
        if like:
            expected[d, i] = like
    found = line_dedup.repeated_lines(frame(spark, docs)).collect()
    assert {(r.doc_id, r.line_no): (r.like_doc_id, r.like_line_no, r.edits) for r in found} == expected
    left = {r.doc_id: r.text for r in line_dedup.without_repeats(frame(spark, docs)).collect()}
    for d, text, *_ in docs:
        if d is not None and text is not None:
            kept = [x for i, x in enumerate(text.split("\n")) if (d, i) not in expected]
            assert left[d] == "\n".join(kept)


def test_licences(spark):
    filler = "und so weiter in dem Text der nichts mit dem zu tun hat was hier gesucht wird " * 3
    rows = [
        (1, filler + "Released under the MIT License. " + filler, "en", "s", 0),
        (2, "licensed under cc by-nc 4.0", "en", "s", 0),
        (3, "Licensed under CC BY 4.0.", "en", "s", 0),
        (4, filler + licenses.TEMPLATES[4].text.replace("software", "program") + filler, "en", "s", 0),
        (5, "Released under the BSD License.", "en", "s", 0),
        (6, filler, "en", "s", 0),
        (7, "This work is licensed under the new GNU General Public License, version 3. " * 3, "en", "s", 0),
    ]
    found = licenses.scan(frame(spark, rows)).collect()
    assert {(r.doc_id, r.license) for r in found} == {
        (1, "MIT"), (2, "CC-BY-NC-4.0"), (3, "CC-BY-4.0"), (4, "MIT"), (7, "GPL-3.0")
    }


def test_increasing_is_longest():
    rng = random.Random(7)
    for _ in range(100):
        x = rng.sample(range(20), rng.randrange(0, 9))
        best = [1] * len(x)
        for i in range(len(x)):
            best[i] = 1 + max([best[j] for j in range(i) if x[j] < x[i]], default=0)
        got = [x[i] for i in licenses.increasing(x)]
        assert got == sorted(got) and len(got) == max(best, default=0)


def test_secrets(spark):
    rng = random.Random(12)
    rows, expected = [], set()
    for d in range(80):
        words = ["".join(rng.choice("etaoin") for _ in range(rng.randrange(3, 22))) for _ in range(40)]
        text = " ".join(words) + f" {rng.randrange(10**15, 10**16)} "
        if d % 4 == 0:
            text += 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '" end'
            expected.add(d)
        rows.append((d, text, "en", "s", 0))
    found = secrets.scan(frame(spark, rows)).collect()
    assert {r.doc_id for r in found} == expected
    assert all(r.length == 40 and r.named for r in found)


@pytest.mark.parametrize(
    "form, key",
    [
        ("password={}", "Abcdef1234567890XYZ9"),
        ("export API_TOKEN={}\n", "Zx81mQp0Lr72Ks93Vt64"),
        ("see https://x.org/a?token={}&b=1", "Zx81mQp0Lr72Ks93Vt64"),
        ("AWS_SECRET_ACCESS_KEY={}", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"),
        ("secret={} end", "QWxhZGRpbjpvcGVuIHNlc2FtZQ=="),
    ],
)
def test_secret_after_equals_sign(spark, form, key):
    found = secrets.described(secrets.candidates(frame(spark, [(1, form.format(key), "en", "s", 0)])))
    rows = {r.token: r for r in found.collect()}
    assert rows[key].named == rows[key].assigned == 1
    assert set(rows) <= {key, "AWS_SECRET_ACCESS_KEY"}


def test_secrets_of_assignments(spark):
    rng = random.Random(13)
    rows, expected = [], set()
    for d in range(80):
        words = ["".join(rng.choice("etaoin") for _ in range(rng.randrange(3, 22))) for _ in range(40)]
        text = " ".join(words)
        if d % 4 == 0:
            form = ("\nAWS_SECRET_ACCESS_KEY={}\n", "\nexport API_KEY={}\n", " https://x.org/a?token={} ")[d % 3]
            text += form.format("".join(rng.choice("0123456789abcdefghXYZ") for _ in range(40)))
            expected.add(d)
        rows.append((d, text, "en", "s", 0))
    found = secrets.scan(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.length) for r in found) == sorted((d, 40) for d in expected)


def test_copied_secrets_make_no_dictionary(spark):
    rng = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(6)]
    rows = []
    for d in range(120):
        words = ["".join(rng.choice("etaoin") for _ in range(rng.randrange(3, 22))) for _ in range(40)]
        text = " ".join(words) + f' token = "{keys[d % 6]}"' * (d < 60)
        rows.append((d, text, "en", "s", 0))
    docs = frame(spark, rows)
    found = secrets.with_coverage(secrets.described(secrets.candidates(docs)), secrets.dictionary(docs))
    labels = secrets.sure_findings(found.filter("named = 1")).select("label", "coverage").distinct()
    assert [tuple(r) for r in labels.collect()] == [(1.0, 0.0)]
    assert sorted(r.doc_id for r in secrets.scan(docs).collect()) == list(range(60))


def test_quality_measures(spark):
    rows = [
        (1, "a b c d e f " * 2, "en", "s", 0),
        (2, "the cat and the dog of a man in a hat\nthe cat and the dog of a man in a hat", "en", "s", 0),
        (3, "the cat and the dog of a man in a hat is not that bad as it was", "en", "s", 0),
        (4, " ".join(f"word{i}###" for i in range(30)), "en", "s", 0),
        (5, "é ü 漢字", "en", "s", 0),
    ]
    got = {r.doc_id: r for r in quality.judged(frame(spark, rows)).collect()}
    assert (got[1].n_words, got[1].n_repeat_words, got[1].base_failed) == (12, 12, True)
    assert (got[2].n_dup_lines, got[2].base_failed) == (1, True)
    assert got[3].kept and not got[4].kept and not got[4].base_failed
    assert (got[5].word_chars, got[5].n_words) == (4, 3)


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_files(spark, vocabulary, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    rng = random.Random(3)
    odd = ["", None, " ", "\n", "a\n\nb", "a \nb", "a\n b", "  a  b ", "don't 's x's 'S", "é è\nÉ", "× ÷ a ×",
           "\ta\tb", "x" * 3000 + " y", "<|endoftext|> a", "1 2\n3a4", "œuf – x", "a\r\nb", "汉字 汉字\n汉", "😀 😀 a",
           "a b c", "''a ''", "-a -b1"]
    rows = [(d * 3, t, "en", "s", 0) for d, t in enumerate(odd)]
    alphabet = ["ab", "été", "foo,", "12", "'s", "don't", "X-y", "!"]
    for d in range(200):
        rows.append((1000 - d, " ".join(rng.choice(alphabet) for _ in range(rng.randrange(400))), "en", "s", 0))
    rows += [(5000, "same", "en", "s", 0)] * 2 + [(None, "first", "en", "s", 0)]
    rng.shuffle(rows)
    found = token_file.encode_and_read_back(frame(spark, rows), vocabulary)
    expected, start = [], 0
    for d, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [token_file.END]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        expected.append((d, start, len(ids), crc))
        start += len(ids)
    key = lambda r: (r[1], r[0] or 0)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    folder = str(tmp_path / "tokens")
    token_file.write_token_file(frame(spark, rows), folder, vocabulary)
    blocks = [r.asDict() for r in spark.read.parquet(folder).collect()]
    assert any(len(b["rules"]) for b in blocks)
    for b in blocks:
        every = token_file.decode(b, tokenizer.get_vocab_size())
        for k in range(0, len(every), 7):
            (one,) = token_file.decode(b, tokenizer.get_vocab_size(), range(k, k + 1))
            assert one.tolist() == every[k].tolist()
    assert token_file.encode_and_read_back(frame(spark, []), vocabulary).count() == 0
