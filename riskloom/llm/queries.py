"""One named query per corpus operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontam, fingerprint, htmltext, langid, licences, merkle, pieces, runs, shards, simhash, suffixes, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Where the vocabulary of the piece encoder lies; it has to be readable on every executor.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to piece ids and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode_pieces(docs, PIECE_MODEL)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "library_agrees",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(column: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION_SQL = f"""
WITH b AS (SELECT cast(item_id AS varchar) AS item, {_sql_words("text")} AS w FROM benchmark),
bw AS (SELECT item, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS k FROM bw),
d AS (SELECT doc_id, {_sql_words("text")} AS w FROM {{documents}}),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
       unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS k
       FROM d JOIN sizes ON len(w) >= n),
occ AS (SELECT DISTINCT doc_id, dw.n, i, item FROM dw JOIN win ON dw.k = win.k AND dw.n = win.n),
hits AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ WHERE item IS NOT NULL) GROUP BY 1),
judged AS (SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
       FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id))
"""
ORACLES["op9_decontamination"] = DECONTAMINATION_SQL.format(documents="documents") + "SELECT * FROM judged"


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in a benchmark window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


# Site rules as given, and the method's own pattern rules.
SITE_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
PATTERN_RULES = [
    ("cheap-pills", r"^(?:[^/]*\.)?cheap-pills\.", ("cheap", "pills")),
    ("spam-farm", r"^(?:[^/]*\.)?spam-farm\.", ("spam", "farm")),
    ("casino", r"(?:^|[./-])casino(?:[./-]|$)", ("casino",)),
    ("porn", r"(?:^|[./-])porn(?:[./-]|$)", ("porn",)),
    ("adserver", r"^(?:[^/]*\.)?adserver\.", ("adserver",)),
    ("login page", r"/login(?:[./]|$)", ("login",)),
]


def _url_rules() -> list[urlfilter.UrlRule]:
    sites = [urlfilter.site_rule(rule, verdict) for rule, verdict in SITE_RULES]
    return sites + [urlfilter.pattern_rule(name, "block", pattern, tokens) for name, pattern, tokens in PATTERN_RULES]


def _sql_site(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"


def _sql_cases(pairs: list[tuple[str, str]], last: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{value}'" for test, value in pairs) + f" ELSE {last} END"


_BY_LENGTH = sorted(SITE_RULES, key=lambda r: (len(r[0]), r[0]), reverse=True)
_PATTERNS_BY_LENGTH = sorted(PATTERN_RULES, key=lambda r: (len(r[0]), r[0]), reverse=True)
ORACLES["op5_url_filter"] = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, {_sql_cases([(_sql_site(r), r) for r, _ in _BY_LENGTH], "NULL")} AS rule,
      {_sql_cases([(f"regexp_matches(host || path, '{p}')", n) for n, p, _ in _PATTERNS_BY_LENGTH], "NULL")} AS fits FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN fits END AS pattern,
  CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in SITE_RULES)} WHEN fits IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the site rules, then the pattern rules."""
    return urlfilter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), _url_rules()).drop("url")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Fitted on the rows outside the test fold."""
    return langid.fit_language_model(docs.select("doc_id", "text", "lang").where(~langid.held_out(F.col("doc_id"))))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language."""
    docs = table(spark, sf_dir, "documents")
    told = langid.predict_language(docs.select("doc_id", "text"), language_model(docs))
    return told.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike they are."""
    compared = fingerprint.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint.to_hex(F.col("lanes")).alias("fingerprint"),
        fingerprint.to_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings that start earlier as well."""
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    model = htmltext.fit_page_model(pages)
    return htmltext.extract_text(pages, model).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


SHARDS = [f"shard-{i:03d}" for i in range(128)]


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, by its id."""
    return shards.assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


# The filled table is the method; that keys are placed by it, and evenly, is checked beside it.
_SLOTS = ", ".join(map(str, shards.fill_table(SHARDS).tolist()))
ORACLES["op2_sharding"] = f"""
WITH t AS (SELECT [{_SLOTS}] AS owners),
s AS (SELECT doc_id, CASE WHEN doc_id IS NULL THEN 0
  ELSE cast(('0x' || substr(md5(cast(doc_id AS varchar)), 1, 15))::bigint % {shards.TABLE_SIZE} AS integer) END AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(cast(owners[slot + 1] AS varchar), 3, '0') AS shard FROM s, t"""


# Words that label the first two categories among the labelled documents.
INSULTS = ["idiot", "moron", "clown", "loser", "scum", "stupid"]
DEGRADING = ["trash", "worthless", "pathetic", "disgusting"]
CATEGORIES = ["insult", "degrading", "toxic"]


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of each toxicity category."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    sample = toxicity.labelled_sample(docs, labels, "toxic")
    marked = sample.withColumns(
        {name: toxicity.holds_word(F.col("text"), words) * F.col("toxic") for name, words in (("insult", INSULTS), ("degrading", DEGRADING))}
    )
    chain = toxicity.fit_chain(marked, CATEGORIES)
    return toxicity.predict_toxicity(docs, chain).drop("text")


# The base phrases and their labels.
LICENCE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


@query
def op11_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence phrases and labels."""
    scanned = licences.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"), LICENCE_PHRASES)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places.word").alias("first_word"),
        F.array_max("base_places.word").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_min("expressions.freedom").alias("freedom"),
    )


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """Unsigned CRC-32 of the id in decimals; null without id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether its tampered form is found out."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(*fields)
    tampered = F.when(crc_of_id() % 5 == 0, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    leaf = merkle.leaf_digest([F.col(c) for c in fields])
    claimed = merkle.leaf_digest([*[F.col(c) for c in fields[:-1]], tampered])
    digests = docs.select("doc_id", "source", leaf.alias("own"), claimed.alias("told"))
    proved = merkle.merkle_manifest(digests, "source", "doc_id", F.col("own"), F.col("told"))
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_crc(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda s: ord(s)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {byte}), 4294967295)"


def _sql_tree(name: str, start: str, tree: str, depth: int) -> str:
    """CTEs ``<name>0 .. <name>depth``: nodes of each level with what stands left and right of them in their run.

    ``start`` has (tree, i, h). A tree with one node left is carried along unchanged.
    """
    run = f"PARTITION BY {tree}, i // 16 ORDER BY i ROWS BETWEEN"
    out = []
    source = start
    for k in range(depth + 1):
        out.append(
            f"""{name}{k} AS (SELECT {tree}, i, h, count(*) OVER (PARTITION BY {tree}) AS n,
      coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {source})"""
        )
        source = f"""(SELECT {tree}, i // 16 AS i, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
      FROM {name}{k} GROUP BY ALL)"""
    return ",\n".join(out)


# Levels that the SQL goes up: 16 million leaves of one source, and as many sources.
_DEPTH = 6


def _sql_fold(name: str, tree: str, on: str, index: str, digest: str, k: int) -> tuple[str, str, str]:
    """Join, next digest and siblings of level ``k``."""
    join = f"JOIN {name}{k} ON {name}{k}.{tree} IS NOT DISTINCT FROM {on} AND {name}{k}.i = {index} // {16**k}"
    folded = f"CASE WHEN {name}{k}.n = 1 THEN {digest} ELSE sha256({name}{k}.l || {digest} || {name}{k}.r) END"
    return join, folded, f"{name}{k}.l || {name}{k}.r"


def _sql_merkle() -> str:
    def leaf(text: str) -> str:
        fields = ["cast(doc_id AS varchar)", "source", "lang", "cast(n_chars AS varchar)", text]
        return "sha256(" + " || ".join(f"coalesce(cast(octet_length(encode({f})) AS varchar) || ':' || {f}, '-')" for f in fields) + ")"

    tampered = f"CASE WHEN {_sql_crc('cast(doc_id AS varchar)')} % 5 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END"
    parts = [
        f"WITH d AS (SELECT doc_id, source, {leaf('text')} AS h, {leaf(tampered)} AS told FROM documents)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM d)",
        _sql_tree("s", "(SELECT source, i, h FROM leaves)", "source", _DEPTH),
        f"tops AS (SELECT 0 AS one, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h FROM s{_DEPTH})",
        _sql_tree("t", "(SELECT one, i, h FROM tops)", "one", _DEPTH),
        f"f0 AS (SELECT leaves.doc_id, leaves.h AS leaf, tops.h AS subroot, t{_DEPTH}.h AS root, leaves.source, leaves.i, tops.i AS j, leaves.told AS folded, '' AS proof"
        f" FROM leaves JOIN tops ON tops.source IS NOT DISTINCT FROM leaves.source CROSS JOIN t{_DEPTH})",
    ]
    at = 0
    for name, tree, on, index in (("s", "source", "source", "i"), ("t", "one", "0", "j")):
        for k in range(_DEPTH):
            f = f"f{at}"
            join, folded, siblings = _sql_fold(name, tree, on if on == "0" else f"{f}.{on}", f"{f}.{index}", f"{f}.folded", k)
            parts.append(f"f{at + 1} AS (SELECT {f}.* EXCLUDE (folded, proof), {folded} AS folded, proof || {siblings} AS proof FROM {f} {join})")
            at += 1
    last = f"SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM f{at}"
    return ",\n".join(parts) + "\n" + last


ORACLES["op12_merkle"] = _sql_merkle()


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of which one in ten (by id) is made periodic from some word on."""
    h = crc_of_id()
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    chosen = chosen.where(F.col("w").isNotNull() & (n > 0)).withColumn("a", F.col("g") % n)
    chosen = chosen.withColumn("p", F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int") + 1).withColumn("a", F.col("a").cast("int"))
    rest = n.cast("int") - F.col("a")
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    copies = F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(copies, F.lit(1), rest)), " ")
    untouched = docs.where(~F.coalesce((h % 10 == 0) & (F.size(words) > 0), F.lit(False))).select("doc_id", "text")
    return untouched.unionByName(chosen.select("doc_id", planted.alias("text")))


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, its strongest one, and what is left without the repeats."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("strongest")
    return runs.find_runs(docs).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
