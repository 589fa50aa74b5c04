"""Near duplicates: texts, vectors, token sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.dedup import EXACT_2
from catalogue.registry import asof, dealt_out, for_oracle, from_sql, query, table, with_views
from catalogue.views import EV_NEW
from kalendra.functions import similarity, text
from kalendra.operators import groups, similar, soft_tokens
from kalendra.operators.daily_similar import SimilarStore
from kalendra.operators.dedup import SAME_EVENT_KEYS, SAME_SLOT_KEYS, drop_exact
from kalendra.plans.workflows import remove_duplicates
from kalendra.session import cut_lineage, fresh_folder


def lcs_sql(a: str, b: str) -> str:
    """Length of the longest common subsequence by folding table rows over the letters of a."""
    cell = (
        f"case when {b}[j] = {a}[i] then r[j] + 1 "
        "else greatest(r[j + 1], c[len(c)]) end"
    )
    row = f"list_reduce(range(1, len({b}) + 1), lambda c, j: list_append(c, {cell}), [0::bigint])"
    start = f"list_transform(range(0, len({b}) + 1), lambda z: 0::bigint)"
    table_rows = f"list_reduce(range(1, len({a}) + 1), lambda r, i: {row}, {start})"
    return f"case when len({a}) = 0 or len({b}) = 0 then 0 else ({table_rows})[len({b}) + 1] end"


def similar_sql(a: str, b: str, slack: int) -> str:
    """ratio > 1 - slack/100 in integers; the edit distance settles most pairs."""
    total = f"(len({a}) + len({b}))"
    return (
        f"case when {a} = {b} then true "
        f"when 100 * levenshtein({a}, {b}) >= {slack} * {total} then false "
        f"else 100 * ({total} - 2 * {lcs_sql(a, b)}) < {slack} * {total} end"
    )


# Part names as a stand-in for subjects: each distinct name against each other of its brand.
NAMES = """
select p_partkey as row_seq, concat(p_name, ' ', p_type, ' ', cast(p_size as string)) as subject,
       p_brand as city
from {part}
"""


@query(
    "indel_ratio",
    with_views(
        f"""
        select row_seq, {lcs_sql('subject', 'c_name')} as lcs,
               round(2.0 * {lcs_sql('subject', 'c_name')} / (len(subject) + len(c_name)), 6) as ratio
        from (select row_seq, subject, c_name
              from (select *, row_seq % (select count(*) from customer) as key from names)
              join customer on c_custkey = key)
        """,
        names=NAMES,
    ),
)
def indel_ratio(spark, sf):
    customers = table(spark, sf, "customer")
    names = from_sql(spark, sf, NAMES)
    pairs = names.join(customers, F.expr(f"c_custkey = row_seq % {customers.count()}"))
    a, b = F.col("subject"), F.col("c_name")
    return pairs.select(
        "row_seq",
        similarity.lcs_length_batched(a, b).cast("long").alias("lcs"),
        F.round(similarity.ratio(a, b), 6).alias("ratio"),
    )


NAME_NODES = "select city, subject, min(row_seq) as node from names group by city, subject"
NAME_PAIRS = f"""
select a.node as src, b.node as dst
from nodes a join nodes b on a.city = b.city and a.subject < b.subject
where {similar_sql('a.subject', 'b.subject', 10)}
"""


@query("fuzzy_pairs", with_views(NAME_PAIRS, names=NAMES, nodes=NAME_NODES))
def fuzzy_pairs(spark, sf):
    nodes = cut_lineage(similar.text_nodes(from_sql(spark, sf, NAMES), ["city"], "subject", "row_seq"))
    return similar.text_edges(nodes, ["city"], "subject", 10)


def greedy_sql(ordered: str, pairs: str) -> str:
    """Visit nodes of each block in order; `ordered` has blk, rn, node; `pairs` has src, dst.

    Returns surviving nodes.
    """
    return f"""
    visit as (
        select blk, rn, [node] as survivors from {ordered} where rn = 1
        union all
        select v.blk, o.rn,
               case when exists (select 1 from {pairs} p
                                 where p.dst = o.node and list_contains(v.survivors, p.src))
                    then v.survivors else list_append(v.survivors, o.node) end
        from visit v join {ordered} o on o.blk = v.blk and o.rn = v.rn + 1
    ),
    survivors as (
        select unnest(arg_max(survivors, rn)) as node from visit group by blk
    )
    """


def greedy_views(source: str, block: str, subject: str, pairs: str, **views: str) -> str:
    """CTE text: nodes, ordered nodes, pairs and the survivors of the greedy visit."""
    nodes = f"""
        select {block} as blk, {subject} as subject, min(row_seq) as node
        from {source} where {block} is not null and {subject} is not null group by all
    """
    ordered = """
        select blk, node, row_number() over (partition by blk order by subject, node) as rn
        from nodes
    """
    texts = {**{k: for_oracle(v) for k, v in views.items()}, "nodes": nodes, "ordered": ordered,
             "pairs": pairs}
    parts = ",\n".join(f"{name} as materialized ({sql})" for name, sql in texts.items())
    return f"with recursive {parts},\n{greedy_sql('ordered', 'pairs')}"


FUZZY_BLOCK = (
    "case when start_date is null or city is null then null else "
    "concat(start_date, '|', coalesce(start_time, 'missing time'), '|', city) end"
)
TEXT_PAIRS = f"""
    select a.node as src, b.node as dst
    from nodes a join nodes b on a.blk = b.blk and a.subject < b.subject
    where {similar_sql('a.subject', 'b.subject', 10)}
"""
FUZZY = greedy_views(
    "exact", FUZZY_BLOCK, "subject", TEXT_PAIRS, ev_new=EV_NEW, exact=EXACT_2
)
SURVIVES = f"row_seq in (select node from survivors) or ({FUZZY_BLOCK}) is null or subject is null"


def _exact(spark, sf):
    events = from_sql(spark, sf, EV_NEW)
    return drop_exact(drop_exact(events, SAME_EVENT_KEYS), SAME_SLOT_KEYS)


@query("dedup_fuzzy", f"{FUZZY} select * from exact where {SURVIVES}")
def dedup_fuzzy(spark, sf):
    return similar.fuzzy_dedup(_exact(spark, sf))


@query("dedup_increment", f"{FUZZY} select * from exact where {SURVIVES}")
def dedup_increment(spark, sf):
    """The same removal, of rows that arrive over three days."""
    rows = cut_lineage(_exact(spark, sf).withColumn("_time", F.coalesce("start_time", F.lit("missing time"))))
    block = ["start_date", "_time", "city"]
    store = SimilarStore(spark, fresh_folder(spark, "similar-store"), rows.schema, block)
    last = rows.agg(F.max("row_seq")).first()[0] or 0
    for day in range(3):
        # The first day has no lower end, so that row 0 is not left out.
        later = F.col("row_seq") * 3 > last * day if day else F.lit(True)
        store.add(rows.filter(later & (F.col("row_seq") * 3 <= last * (day + 1))))
    return store.kept_rows(rows).drop("_time")


@query(
    "remove_duplicates",
    f"""{FUZZY}
    select * replace ('Ladedatum: 10-01-2024, ' || category || ', ' || description || ', ' || city
                      || case when music_label then ' Musik' else '' end as description),
           '10-01-2024' as load_date
    from exact where {SURVIVES}
    """,
)
def remove_all_duplicates(spark, sf):
    return remove_duplicates(from_sql(spark, sf, EV_NEW), asof())


# Vectors with a made-up subject; the label is the block. No two vectors of the test table reach the
# usual 0.8, so the queries use 0.35.
VECTORS = """
select v.vec_id as row_seq, concat(p.p_name, ' ', cast(v.vec_id as string)) as subject,
       v.label as label, v.embedding as embedding
from (select *, vec_id % (select count(*) from {part}) as part_no from {embeddings}) v
join {part} p on p.p_partkey = v.part_no
"""
COSINE = "list_cosine_similarity(a.embedding, b.embedding)"


@query(
    "cosine_pairs",
    with_views(
        f"""
        select a.row_seq as src, b.row_seq as dst
        from v a join v b on a.label = b.label and a.subject < b.subject where {COSINE} > 0.35
        """,
        v=VECTORS,
    ),
)
def cosine_pairs(spark, sf):
    nodes = from_sql(spark, sf, VECTORS).withColumnsRenamed({"row_seq": "node"})
    return similar.cosine_edges(nodes, ["label"], "subject", "embedding", 0.35)


def _vector_pairs(condition: str) -> str:
    return f"""
    select a.row_seq as src, b.row_seq as dst
    from v a join v b on a.label = b.label and a.subject < b.subject where {condition}
    """


OR_PAIRS = _vector_pairs(f"{COSINE} > 0.35 or {similar_sql('a.subject', 'b.subject', 15)}")
AND_PAIRS = _vector_pairs(f"{COSINE} > 0.1 and {similar_sql('a.subject', 'b.subject', 10)}")
OR_VISIT = greedy_views("v", "label", "subject", OR_PAIRS, v=VECTORS)
AND_VISIT = greedy_views("v", "label", "subject", AND_PAIRS, v=VECTORS)


@query(
    "dedup_embed_or",
    f"""{OR_VISIT}
    select row_seq, subject, label, row_seq in (select node from survivors) as kept from v
    """,
)
def dedup_embed_or(spark, sf):
    """Both outputs, kept and dropped rows, in one frame."""
    kept, dropped = similar.embedding_dedup(
        from_sql(spark, sf, VECTORS), ["label"], "embedding", mode="or", cosine_above=0.35
    )
    columns = ["row_seq", "subject", "label"]
    return (
        kept.select(*columns)
        .withColumn("kept", F.lit(True))
        .unionByName(dropped.select(*columns).withColumn("kept", F.lit(False)))
    )


@query(
    "dedup_embed_and",
    f"{AND_VISIT} select row_seq, subject, label from v where row_seq in (select node from survivors)",
)
def dedup_embed_and(spark, sf):
    kept, _ = similar.embedding_dedup(
        from_sql(spark, sf, VECTORS), ["label"], "embedding", mode="and", cosine_above=0.1
    )
    return kept.select("row_seq", "subject", "label")


# ---- token sets --------------------------------------------------------------------------------

TOKENS_SQL = (
    "list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(regexp_replace("
    "lower({x}), '[^\\p{{L}}\\p{{N}}_\\s&]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), "
    "lambda w: w <> '')))"
)


def tokens_sql(column: str) -> str:
    return TOKENS_SQL.format(x=column)


DOC_TOKENS = f"select doc_id as row_seq, {tokens_sql('text')} as toks, [lang] as place from documents"
# Pairs by counting common words: |a and b| / |a or b| >= 0.8 in integers.
DOC_PAIRS = """
select src, dst from (
    select a.row_seq as src, b.row_seq as dst, a.n as na, b.n as nb, count(*) as common
    from words a join words b on a.w = b.w and a.row_seq < b.row_seq
         and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) {and_place}
    group by all)
where 100 * common >= 80 * (na + nb - common)
"""
WORDS = "select row_seq, place, len(toks) as n, unnest(toks) as w from docs"


@query(
    "jaccard_pairs",
    f"""with docs as materialized ({DOC_TOKENS}), words as materialized ({WORDS})
    {DOC_PAIRS.format(and_place='')}""",
)
def jaccard_pairs(spark, sf):
    """Pairs of rows; documents of one token set are one node for the search."""
    docs = cut_lineage(_documents(spark, sf))
    nodes, rows = groups.token_nodes(docs, ["toks"], "row_seq")
    edges = similar.token_edges(nodes, ["toks"], 80)
    same = nodes.filter(F.size("toks") > 0).select(
        F.col("node").alias("src"), F.col("node").alias("dst")
    )
    a, b = rows.toDF("src", "a"), rows.toDF("dst", "b")
    return (
        edges.unionByName(same)
        .join(a, "src")
        .join(b, "dst")
        .filter((F.col("src") != F.col("dst")) | (F.col("a") < F.col("b")))
        .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
    )


def _documents(spark, sf):
    docs = dealt_out(table(spark, sf, "documents"))
    tokens = text.word_set(F.col("text"))
    return docs.select(
        F.col("doc_id").alias("row_seq"), tokens.alias("toks"), F.array("lang").alias("place")
    )


@query(
    "jaccard_score",
    f"""
    select doc_id, case when len(a) + len(b) = 0 then 0.0 else
           round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) end as score
    from (select doc_id, {tokens_sql('text')} as a, {tokens_sql('other')} as b
          from (select doc_id, text, case when doc_id % 3 > 0 then (select min(text) from benchmark) else '' end as other
                from documents)
          union all select doc_id, [], [] from documents)
    """,
)
def jaccard_score(spark, sf):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")

    def tokens(column):
        return text.word_set(F.col(column))

    least = items.agg(F.min("text")).scalar()
    paired = docs.withColumn("other", F.when(F.col("doc_id") % 3 > 0, least).otherwise(""))
    none = F.array().cast("array<string>")
    sets = paired.select("doc_id", tokens("text").alias("a"), tokens("other").alias("b")).unionByName(
        docs.select("doc_id", none.alias("a"), none.alias("b"))
    )
    return sets.select("doc_id", F.round(similarity.jaccard(F.col("a"), F.col("b")), 6).alias("score"))


# The visit-in-order grouping: pairs sorted by (src, dst), each overwriting earlier labels.
GROUP_PARENTS = """
both_ways as (select src as x, dst as y from pairs union all select dst, src from pairs),
prev as (select x, max(y) filter (where y < x) as before, min(y) filter (where y > x) as after
         from both_ways group by x),
parents as (
    select p.x, coalesce(p.before,
        (select max(b.y) from both_ways b where b.x = p.after and b.y < p.x), p.x) as parent
    from prev p),
roots as (
    select x, parent, x = parent as done from parents
    union all
    select r.x, p.parent, p.parent = p.x from roots r join parents p on p.x = r.parent
    where not r.done),
grouped as (select x, parent as root from roots where done),
numbered as (select root, row_number() over (order by root) - 1 as no from (select distinct root from grouped))
"""
TOKEN_CTE = f"""with recursive docs as materialized ({DOC_TOKENS}),
words as materialized ({WORDS}),
pairs as materialized ({DOC_PAIRS.format(and_place='and a.place = b.place')})"""


@query(
    "token_groups",
    f"""{TOKEN_CTE}, {GROUP_PARENTS}
    select d.row_seq, cast(coalesce(n.no, -1) as integer) as duplicate_group
    from docs d left join grouped g on g.x = d.row_seq left join numbered n on n.root = g.root
    """,
)
def token_groups(spark, sf):
    grouped = groups.duplicate_groups(_documents(spark, sf), ["toks", "place"])
    return grouped.select("row_seq", "duplicate_group")


@query(
    "token_components",
    f"""{TOKEN_CTE},
    reach as (
        select row_seq as x, row_seq as y from docs
        where row_seq in (select src from pairs union select dst from pairs)
        union
        select r.x, case when p.src = r.y then p.dst else p.src end
        from reach r join pairs p on p.src = r.y or p.dst = r.y),
    grouped as (select x, min(y) as root from reach group by x),
    numbered as (select root, row_number() over (order by root) - 1 as no
                 from (select distinct root from grouped))
    select d.row_seq, cast(coalesce(n.no, -1) as integer) as duplicate_group
    from docs d left join grouped g on g.x = d.row_seq left join numbered n on n.root = g.root
    """,
)
def token_components(spark, sf):
    grouped = groups.duplicate_groups(_documents(spark, sf), ["toks", "place"], exact_order=False)
    return grouped.select("row_seq", "duplicate_group")


@query(
    "token_groups_in_order",
    f"""{TOKEN_CTE}, {GROUP_PARENTS},
    placed as (
        select d.row_seq, cast(coalesce(n.no, -1) as integer) as duplicate_group
        from docs d left join grouped g on g.x = d.row_seq left join numbered n on n.root = g.root)
    select row_number() over (order by duplicate_group, row_seq) as place, row_seq, duplicate_group from placed
    """,
)
def token_groups_in_order(spark, sf):
    return groups.ordered_groups(token_groups(spark, sf)).select("place", "row_seq", "duplicate_group")


@query(
    "token_classes",
    f"""{TOKEN_CTE},
    equal as (select *, len(toks) > 0 and len(place) > 0 as filled from docs),
    own as (select *, case when filled then min(row_seq) over (partition by toks, place) else row_seq end as class,
                   case when filled then count(*) over (partition by toks, place) else 1 end as n_equal from equal),
    likes as (select x, count(*) as n from (select src as x, dst as y from pairs union all select dst, src from pairs) p
              join own a on a.row_seq = p.x join own b on b.row_seq = p.y where a.class <> b.class group by x)
    select o.row_seq, o.class, cast(o.n_equal as bigint) as n_equal, coalesce(l.n, 0) as n_like
    from own o left join likes l on l.x = o.row_seq
    """,
)
def token_classes(spark, sf):
    rows, _ = groups.token_classes(_documents(spark, sf), ["toks", "place"])
    return rows


CANONICAL_SOURCE = """
select o_orderkey as row_seq,
       concat(p.p_name, ' ', p.p_brand, ' ', p.p_type, ' halle ',
              case when o.o_orderstatus = 'F' then '(alt)' else '' end, ' nord ',
              case when o.o_orderpriority = '1-URGENT' then 'Eingang B' else '' end) as location
from (select *, o_custkey % (select count(*) from {part}) as part_no from {orders}) o
join {part} p on p.p_partkey = o.part_no
"""
CANONICAL_PAIRS = """
    select src, dst from (
        select a.node as src, b.node as dst, a.n as na, b.n as nb, count(*) as common
        from w a join w b on a.t = b.t and a.node < b.node group by all)
    where 100 * common >= 80 * (na + nb - common)
"""


def _canonical_sql() -> str:
    tokens = f"array_to_string({tokens_sql('location')}, ' ')"
    return f"""
    with recursive s as materialized (
        select row_seq, location, {tokens} as tokens from ({for_oracle(CANONICAL_SOURCE)})),
    vals as materialized (select tokens, min(row_seq) as node from s group by tokens),
    w as (select node, tokens, len(string_split(tokens, ' ')) as n,
                 unnest(string_split(tokens, ' ')) as t from vals),
    pairs as materialized ({CANONICAL_PAIRS}),
    ordered as materialized (select 1 as blk, node, row_number() over (order by node) as rn from vals
                where node in (select src from pairs union select dst from pairs)),
    {greedy_sql('ordered', 'pairs')},
    leaders as (
        select p.dst as node, min(p.src) as leader from pairs p
        where p.src in (select node from survivors) and p.dst not in (select node from survivors)
        group by p.dst)
    select s.row_seq, s.location, coalesce(c.tokens, s.tokens) as canonical
    from s join vals v on v.tokens = s.tokens left join leaders l on l.node = v.node
    left join vals c on c.node = l.leader
    """


@query("canonical_locations", _canonical_sql())
def canonical_locations(spark, sf):
    return groups.canonical_spellings(from_sql(spark, sf, CANONICAL_SOURCE), "location")


@query(
    "tokens_match",
    "select row_seq, levenshtein(a, b) <= 1 as matches from (select p.p_partkey as row_seq, "
    "split_part(p.p_name, ' ', 1) as a, split_part(q.p_name, ' ', 1) as b "
    "from part p join part q on q.p_partkey = p.p_size)",
)
def tokens_match(spark, sf):
    part = table(spark, sf, "part")
    other = part.select(F.col("p_partkey").alias("k"), F.split("p_name", " ")[0].alias("b"))
    return part.join(other, F.col("k") == F.col("p_size")).select(
        F.col("p_partkey").alias("row_seq"),
        similarity.tokens_match(F.split("p_name", " ")[0], F.col("b")).alias("matches"),
    )


# ---- token sets whose words agree up to a letter ------------------------------------------------

# Part titles with slips of the pen: letters changed, left out or doubled, by part number.
TYPOS = """
select p_partkey as row_seq, p_brand as city,
       concat(case p_partkey % 5 when 0 then replace(p_name, 'a', 'o') when 1 then replace(p_name, 'e', '')
                                 when 2 then replace(p_name, 'l', 'll') else p_name end, ' ',
              case p_partkey % 7 when 0 then replace(lower(p_type), 'p', 'b') when 1 then replace(lower(p_type), 'n', '')
                                 else lower(p_type) end, ' ',
              cast(p_size as string), ' ', cast(p_partkey % 13 as string)) as title
from {part}
"""
TYPO_SETS = f"select city, {tokens_sql('title')} as toks, min(row_seq) as node from typos group by all"
# The largest matching by Hall's theorem: over all sets of words of one side, the words left out of it
# and the words of the other side that match one in it; the least sum is the size of the matching.
SOFT_PAIRS = """
select src, dst, matched from (
    select src, dst, na, nb, cast(list_min(list_transform(range(1 << na),
           lambda s: na - bit_count(s) + len(list_filter(near, lambda x: (x & s) <> 0)))) as bigint) as matched
    from (select a.node as src, b.node as dst, len(a.toks) as na, len(b.toks) as nb,
                 list_transform(b.toks, lambda y: cast(list_sum(list_transform(range(len(a.toks)),
                     lambda i: case when levenshtein(a.toks[i + 1], y) <= 1 then 1 << i else 0 end)) as bigint)) as near
          from sets a join sets b on a.city = b.city and a.node < b.node))
where 100 * matched >= 66 * (na + nb - matched)
"""


@query(
    "soft_token_pairs",
    f"with typos as ({for_oracle(TYPOS)}), sets as materialized ({TYPO_SETS}) {SOFT_PAIRS}",
)
def soft_token_pairs(spark, sf):
    titles = from_sql(spark, sf, TYPOS).withColumn("toks", text.token_set(text.normalised(F.col("title"))))
    nodes = cut_lineage(titles.groupBy("city", "toks").agg(F.min("row_seq").alias("node")))
    return soft_tokens.soft_token_edges(nodes, "toks", 66, ["city"])
