"""The distributed operators against plain sequential code on small random inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kalendra.operators import diff_ranked, diff_subject, groups, numbering, similar
from kalendra.operators.dedup import collapse_colocated, drop_exact

WORDS = ["rot", "blau", "live", "rock", "nacht", "fest", "kiel", "jazz", "münster", "a"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        done = [0]
        for j, y in enumerate(b):
            done.append(row[j] + 1 if x == y else max(row[j + 1], done[-1]))
        row = done
    return row[-1]


def alike(a, b, slack):
    total = len(a) + len(b)
    return a == b or 100 * (total - 2 * lcs(a, b)) < slack * total


def greedy(nodes, similar_to):
    kept = []
    for n in nodes:
        if not any(similar_to(k, n) for k in kept):
            kept.append(n)
    return kept


def random_subjects(rng, n):
    out = []
    for _ in range(n):
        base = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))
        letters = list(base)
        for _ in range(rng.randint(0, 2)):
            if letters:
                letters[rng.randrange(len(letters))] = rng.choice("abcx!")
        out.append("".join(letters))
    return out


@pytest.mark.parametrize("slack", [10, 15])
def test_text_edges_find_every_pair(spark, slack):
    rng = random.Random(slack)
    subjects = sorted(set(random_subjects(rng, 160)))
    nodes = spark.createDataFrame(
        [("c", s, i) for i, s in enumerate(subjects)], "city string, subject string, node long"
    )
    found = {tuple(r) for r in similar.text_edges(nodes, ["city"], "subject", slack).collect()}
    expected = {
        (i, j)
        for i, a in enumerate(subjects)
        for j, b in enumerate(subjects)
        if i < j and alike(a, b, slack)
    }
    assert found == expected


def test_fuzzy_dedup_is_the_greedy_visit(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice([s, s, None]) if rng.random() < 0.1 else s, rng.choice(["2024-01-01", None]),
         rng.choice(["10:00", None]), rng.choice(["K", "L"]))
        for i, s in enumerate(random_subjects(rng, 150))
    ]
    df = spark.createDataFrame(
        rows, "row_seq long, subject string, start_date string, start_time string, city string"
    )
    kept = {r.row_seq for r in similar.fuzzy_dedup(df).collect()}
    again = {r.row_seq for r in similar.fuzzy_dedup(df.repartition(7)).collect()}
    expected = set()
    blocks = {}
    for seq, subject, day, clock, city in rows:
        if subject is None or day is None:
            expected.add(seq)
        else:
            blocks.setdefault((day, clock, city), []).append((subject, seq))
    for members in blocks.values():
        survivors = greedy(sorted(members), lambda k, n: alike(k[0], n[0], 10))
        expected |= {seq for _, seq in survivors}
    assert kept == again == expected


def test_settle_random_graph(spark):
    rng = random.Random(5)
    pairs = {(i, j) for i in range(60) for j in range(i + 1, 60) if rng.random() < 0.05}
    edges = spark.createDataFrame(sorted(pairs), "src long, dst long")
    fallen = {r.member for r in similar.settle(edges).collect()}
    kept = greedy(range(60), lambda k, n: (k, n) in pairs)
    assert fallen == set(range(60)) - set(kept)


def test_cosine_edges_over_small_tiles(spark):
    rng = random.Random(7)
    rows = [(i, f"s{i:03d}", i % 2, [rng.gauss(0, 1) for _ in range(3)]) for i in range(80)]
    nodes = spark.createDataFrame(
        rows, "node long, subject string, label int, v array<float>"
    )
    edges = similar.cosine_edges(nodes, ["label"], "subject", "v", 0.8, tile_rows=9)
    found = [tuple(r) for r in edges.collect()]

    def cos(a, b):
        dot = sum(x * y for x, y in zip(a, b, strict=True))
        return dot / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)

    expected = {
        (a[0], b[0]) for a in rows for b in rows
        if a[0] < b[0] and a[2] == b[2] and cos(a[3], b[3]) > 0.8
    }
    assert len(found) == len(set(found)) and set(found) == expected


def token_rows(rng, n):
    return [
        (i, sorted({rng.choice(WORDS) for _ in range(rng.randint(0, 6))}), [rng.choice("ab")])
        for i in range(n)
    ]


def jaccard(a, b):
    a, b = set(a), set(b)
    return bool(a | b) and 100 * len(a & b) >= 80 * len(a | b)


def sequential_groups(rows):
    """Visit all pairs in order; a later row takes the group of the earlier one."""
    label, fresh = {}, 0
    for x in range(len(rows)):
        for y in range(x + 1, len(rows)):
            if jaccard(rows[x][1], rows[y][1]) and jaccard(rows[x][2], rows[y][2]):
                if x in label:
                    label[y] = label[x]
                elif y in label:
                    label[x] = label[y]
                else:
                    label[x] = label[y] = fresh
                    fresh += 1
    return {r[0]: label.get(i, -1) for i, r in enumerate(rows)}


def chain_rows():
    """Overlapping sets, so that groups form chains that are no cliques."""
    letters = [f"w{i}" for i in range(24)]
    order = list(range(15)) * 2
    random.Random(11).shuffle(order)
    return [(i, sorted(letters[k : k + 10]), ["x"]) for i, k in enumerate(order)]


@pytest.mark.parametrize("rows", [token_rows(random.Random(1), 120), chain_rows()])
def test_duplicate_groups(spark, rows):
    df = spark.createDataFrame(rows, "row_seq long, s array<string>, l array<string>")
    exact = groups.duplicate_groups(df, ["s", "l"])
    assert {r.row_seq: r.duplicate_group for r in exact.collect()} == sequential_groups(rows)
    parts = groups.duplicate_groups(df, ["s", "l"], exact_order=False).collect()
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = set()
    for x in range(len(rows)):
        for y in range(x + 1, len(rows)):
            if jaccard(rows[x][1], rows[y][1]) and jaccard(rows[x][2], rows[y][2]):
                parent[max(root(x), root(y))] = min(root(x), root(y))
                linked |= {x, y}
    numbers = {r: i for i, r in enumerate(sorted({root(x) for x in linked}))}
    assert {r.row_seq: r.duplicate_group for r in parts} == {
        i: numbers[root(i)] if i in linked else -1 for i in range(len(rows))
    }


def test_canonical_spellings(spark):
    rng = random.Random(13)
    names = [" ".join(rng.sample(WORDS[:7], rng.randint(4, 7))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(names)), "row_seq long, location string")
    found = {r.row_seq: r.canonical for r in groups.canonical_spellings(df, "location").collect()}
    keys = [" ".join(sorted(set(n.split()))) for n in names]
    mapping = {}
    for one in dict.fromkeys(keys):
        if one in mapping:
            continue
        mapping[one] = one
        for other in dict.fromkeys(keys):
            if other not in mapping and jaccard(one.split(), other.split()):
                mapping[other] = one
    assert found == {i: mapping[k] for i, k in enumerate(keys)}


def test_numbering_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(numbering, "BUCKET_BITS", 3)
    rng = random.Random(17)
    values = rng.sample(range(1000), 120)
    df = spark.createDataFrame([(v, v % 3) for v in values], "row_seq long, g int")
    numbered = {r.row_seq: r.row_no for r in numbering.dense_number(df, "row_seq").collect()}
    assert numbered == {v: i + 1 for i, v in enumerate(sorted(values))}
    for r in numbering.with_neighbours(df, "g", "row_seq").collect():
        mates = sorted(v for v in values if v % 3 == r.g)
        at = mates.index(r.row_seq)
        assert r.before == (mates[at - 1] if at else None)
        assert r.after == (mates[at + 1] if at + 1 < len(mates) else None)


def events(rng, n, subjects=("A!", "a", "B", None)):
    return [
        (i, rng.choice(subjects), f"2024-01-{rng.randint(10, 13)}", f"2024-01-{rng.randint(8, 13):02d}",
         rng.choice(["10:00", "9:00", None]), rng.choice(["11:00", None]), rng.choice(["h", "g", None]),
         rng.choice(["K", "L", None]), rng.choice(["d", None]), rng.choice(["x", "y", None]),
         rng.choice([True, False, None]), rng.choice([1, 4, None]))
        for i in range(n)
    ]


EVENT = (
    "row_seq long, subject string, start_date string, end_date string, start_time string, "
    "end_time string, location string, city string, description string, category string, "
    "music_label boolean, colour int"
)


def event_frame(spark, rows):
    df = spark.createDataFrame(rows, EVENT)
    return df.withColumn("start_date", F.to_date("start_date")).withColumn(
        "end_date", F.to_date("end_date")
    )


@pytest.mark.parametrize("piece", [1, 100_000])
def test_diff_ranked_pieces_change_nothing(spark, monkeypatch, piece):
    monkeypatch.setattr(diff_ranked, "ROWS_PER_PIECE", piece)
    rng = random.Random(19)
    today, previous = (event_frame(spark, events(rng, 60)) for _ in range(2))
    asof = F.lit("2024-01-10").cast("date")
    found = sorted(map(str, diff_ranked.diff_ranked(today, previous, asof).collect()))
    today.createOrReplaceTempView("t0")
    previous.createOrReplaceTempView("p0")
    ranked = (
        "select *, rank() over (partition by subject order by start_date, start_time) r, "
        "lower(regexp_replace(subject, '[^a-zA-Z0-9]', '')) k from {} "
        "where end_date >= date '2024-01-10'"
    )
    joined = spark.sql(
        f"select t.*, p.* from ({ranked.format('t0')}) t full outer join ({ranked.format('p0')}) p "
        "on t.k = p.k and t.r = p.r and t.city = p.city"
    )
    names = [f"{s}_{c}" for s in "tp" for c in today.columns + ["r", "k"]]
    updated, status = diff_ranked._told("t", "p")
    expected = joined.toDF(*names).select(
        *[F.coalesce(f"t_{c}", f"p_{c}").alias(c) for c in diff_ranked.CARRIED],
        updated.alias("updated_description"),
        status.alias("status"),
    )
    assert found == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("crowded", [0, 10**9])
@pytest.mark.parametrize("percent", [60, 80, 95])
def test_token_edges_by_one_word_and_by_two(spark, monkeypatch, crowded, percent):
    """Few words in many sets: both ways of meeting give all pairs."""
    monkeypatch.setattr(similar, "CROWDED", crowded)
    rng = random.Random(percent)
    sets = {tuple(sorted(rng.sample(WORDS, rng.randrange(0, 9)))) for _ in range(150)}
    rows = [(k, list(words)) for k, words in enumerate(sorted(sets))]
    nodes = spark.createDataFrame(rows, "node long, words array<string>")
    expected = {
        (x, y) for x, a in rows for y, b in rows
        if x < y and a and b and 100 * len({*a} & {*b}) >= percent * len({*a} | {*b})
    }
    assert {tuple(r) for r in similar.token_edges(nodes, ["words"], percent).collect()} == expected


def test_classes_stand_for_all_pairs_of_a_crowd(spark):
    """100 000 rows of a few texts: nearly 5 * 10**9 pairs, none of them written out."""
    a, b = ([first] + [f"w{k}" for k in range(9)] for first in "xy")
    df = spark.range(100_000).select(
        F.col("id").alias("row_seq"),
        F.when(F.col("id") % 2 == 0, F.array(*map(F.lit, a))).when(F.col("id") % 10 == 1, F.array(*map(F.lit, b)))
        .when(F.col("id") == 3, F.array(F.lit("other"))).otherwise(F.array().cast("array<string>")).alias("toks"),
    )
    rows, links = groups.token_classes(df, ["toks"])
    assert [tuple(r) for r in links.collect()] == [(0, 1, 50_000 * 10_000)]
    kinds = {tuple(r) for r in rows.filter("n_equal > 1").select("class", "n_equal", "n_like").distinct().collect()}
    assert kinds == {(0, 50_000, 10_000), (1, 10_000, 50_000)}
    alone = rows.filter("n_equal = 1")
    assert alone.count() == 40_000 and alone.filter("class <> row_seq or n_like > 0").isEmpty()


def test_rows_in_order_have_their_places(spark):
    rng = random.Random(12)
    rows = [(rng.choice([None, "a", "b", "c"]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(7)
    got = [tuple(r) for r in numbering.in_order(df, ["g", "k"]).collect()]
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert got == [(g, k, n + 1) for n, (g, k) in enumerate(expected)]
    assert numbering.in_order(df.limit(0), ["g"]).collect() == []


def test_equal_rows_of_a_frequent_key_are_spread(spark, monkeypatch):
    """All rows of both sides are one row: a single pair is compared, and its copies come from all
    tasks alike."""
    monkeypatch.setattr(diff_ranked, "ROWS_PER_PIECE", 10)
    monkeypatch.setattr(diff_ranked, "RUN_BITS", 8)
    row = (0, "s", "2024-01-11", "2024-01-11", "10:00", None, "h", "K", "d", "x", True, 1)
    old = (0, "s", "2024-01-11", "2024-01-11", "10:00", None, "g", "K", "d", "x", True, 1)
    today, previous = event_frame(spark, [row] * 400), event_frame(spark, [old] * 300 + [row])
    found = diff_ranked.diff_ranked(today, previous, F.lit("2024-01-10").cast("date"))
    assert {(r.status, r["count"]) for r in found.groupBy("status").count().collect()} == {
        ("changed", 400 * 300), ("unchanged", 400)
    }
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) >= 8 and max(tasks) < 0.3 * sum(tasks)


def test_diff_of_a_snapshot_with_itself_is_unchanged(spark):
    rows = [(i, f"s{i}", "2024-01-11", "2024-01-11", "10:00", None, "h", "K", "d", "x", True, 1)
            for i in range(30)]
    df = event_frame(spark, rows)
    diffed = diff_ranked.diff_ranked(df, df, F.lit("2024-01-10").cast("date")).collect()
    assert len(diffed) == 30 and {r.status for r in diffed} == {"unchanged"}


def clock(text):
    return None if text is None else text.zfill(5).replace("0000", "00:00")


def fold(new_rows, old_rows):
    """Old rows of a city in order against a growing list of new rows."""
    compared = [("Start Date", 2), ("Start Time", 4), ("End Date", 3), ("End Time", 5),
                ("Location", 6), ("Category", 9)]
    result = []
    for city in sorted({r[7] for r in new_rows + old_rows if r[7] is not None}):
        new = [list(r) for r in new_rows if r[7] == city]
        for old in [r for r in old_rows if r[7] == city]:
            hits = [n for n in new if n[1] is not None and n[1] == old[1]]
            if not hits:
                new.append([*old[:11], 11])
                continue
            for hit in hits:
                if old[11] == 4:
                    hit[11] = 4
                    continue
                changed = [
                    f"\nOriginal {name}: {old[i]}" for name, i in compared
                    if old[i] is not None and hit[i] is not None and old[i] != hit[i]
                ]
                if changed:
                    hit[11] = 5
                    hit[8] = (hit[8] or "") + "".join(changed)
                elif hit[11] not in (4, 5, 11):
                    hit[11] = 10
        for n in new:
            if n[11] not in (4, 5, 11):
                n[11] = 10
        result += new
    return result


@pytest.mark.parametrize("seed", range(4))
def test_diff_by_subject_is_the_fold(spark, seed):
    rng = random.Random(100 + seed)
    subjects = ("A", "B", "C", "D", "E", None)
    new, old = events(rng, 25, subjects[:3] + (None,)), events(rng, 30, subjects)
    found = diff_subject.diff_by_subject(event_frame(spark, new), event_frame(spark, old))
    rows = [
        tuple(str(v) if i in (2, 3) and v is not None else v for i, v in enumerate(r))
        for r in found.select(*[c.split()[0] for c in EVENT.split(", ")]).collect()
    ]
    tidy = [[(r[:4] + (clock(r[4]), clock(r[5])) + r[6:]) for r in part] for part in (new, old)]
    expected = [tuple(r) for r in fold(*tidy)]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_dedup_is_idempotent_and_collapse_drops_null_keys(spark):
    df = event_frame(spark, events(random.Random(23), 80))
    keys = ["subject", "start_date", "start_time", "city"]
    once = drop_exact(df, keys)
    assert sorted(map(str, once.collect())) == sorted(map(str, drop_exact(once, keys).collect()))
    collapsed = collapse_colocated(df.drop("colour")).collect()
    assert all(r.start_time and r.location and r.city for r in collapsed)


def test_a_crowd_of_near_copies_falls_before_pairing(spark):
    crowd = [("K", f"Jazzabend mit der Kapelle Nummer {i:03d} im Hafen", i) for i in range(200)]
    names = sorted(set(random_subjects(random.Random(2), 40)))
    others = [("K", s, 1000 + i) for i, s in enumerate(names)]
    nodes = spark.createDataFrame(crowd + others, "city string, subject string, node long")
    grams = similar._rare_grams(nodes, ["city"], "subject", 10)
    early, rest = similar._first_survivors(grams, ["city"], 10)
    later = similar.settle(similar._gram_pairs(rest, ["city"], 10))
    fallen = {r.member for r in early.unionByName(later).collect()}
    ordered = sorted((s, n) for _, s, n in crowd + others)
    kept = {n for _, n in greedy(ordered, lambda k, n: alike(k[0], n[0], 10))}
    assert fallen == {n for _, n in ordered} - kept
    assert early.count() > 0
