"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.llm.byte_bpe import encode_decode
from clinweave.llm.collocations import collocations
from clinweave.llm.decontaminate import find_items
from clinweave.llm.exact_dedup import exact_duplicates
from clinweave.llm.near_dup import near_duplicates
from clinweave.llm.pii import personal_data
from clinweave.llm.simhash import simhash_groups
from clinweave.llm.spelling import spelling_groups
from clinweave.llm.substring_dedup import dedup_substrings
from clinweave.llm.token_counts import edited_counts, with_edits
from clinweave.llm.token_files import tokens_round_trip
from clinweave.llm.toxicity import fit, toxicity
from clinweave.llm.url_filter import BLOCKED_HOSTS, judge_urls

URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def toxic_model(spark: SparkSession, folder: str, docs: DataFrame):
    return fit(docs, _table(spark, folder, "labels").where(~held_out(F.col("doc_id"))))


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), size=3, percent=85)


def op2_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    marked = exact_duplicates(_table(spark, folder, "documents").select("doc_id", "text"), keep="largest")
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts before and after every run of three digits or more is masked."""
    return edited_counts(with_edits(_table(spark, folder, "documents"), "[0-9]{3,}", "<NUM>")).drop("text_after")


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens_round_trip(_table(spark, folder, "documents"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(_table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    listed = lambda name: F.concat_ws(",", F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.select(
        "doc_id", *(count(k) for k in ("email", "ip", "card", "phone")),
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = dedup_substrings(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(_table(spark, folder, "pages"), URL_RULES)


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(_table(spark, folder, "documents"), digest=True)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity(docs, toxic_model(spark, folder, docs))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = find_items(docs, _table(spark, folder, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(
        "doc_id", "contaminated", F.size(items).cast("bigint").alias("n_items"), F.concat_ws(",", items.cast("array<string>")).alias("item_ids")
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling_groups(_table(spark, folder, "documents"), least=7, occurrences=2, times=10, damage=31)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents"), longest=4, least=30, top=2000, cover=80)


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    grouped = simhash_groups(_table(spark, folder, "documents"), size=3, bits=3)
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_exact_duplicates, op3_token_counts, op4_token_files, op5_personal_data,
        op6_substring_dedup, op7_url_filter, op8_byte_bpe, op9_toxicity, op10_decontamination,
        op11_spelling_variants, op12_collocations, op13_simhash,
    )
}

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(size: int) -> str:
    joined = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return (
        f"CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')] "
        f"ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: {joined})) END"
    )


_LISTED = ", ".join(f"'{h}'" for h in BLOCKED_HOSTS)
_RULES = ", ".join(
    f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in URL_RULES
)

ORACLE = {
    "op1_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, {_shingles(3)} AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
      FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, t.b FROM r JOIN t ON r.b = t.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m ON doc_id = a""",
    "op2_exact_duplicates": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op6_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS pos, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, pos, md5(array_to_string(list_slice(w, pos, pos + 49), ' ')) AS win FROM v),
f AS (SELECT doc_id, pos, doc_id > min(doc_id) OVER (PARTITION BY win) AS gone FROM h),
u AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
c AS (SELECT u.doc_id, u.pos, word,
             coalesce(max(CAST(gone AS INT)) OVER (PARTITION BY u.doc_id ORDER BY u.pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS cut
      FROM u LEFT JOIN f ON u.doc_id = f.doc_id AND u.pos = f.pos),
k AS (SELECT doc_id, count(*) AS n, sum(cut) AS o, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE cut = 0) AS t FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, CAST(coalesce(o, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op7_url_filter": f"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS s FROM pages),
b AS (SELECT page_id, translate(regexp_extract(s, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r(verdict, rule, site, start) AS (VALUES {_RULES}),
f AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM b JOIN r ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start) GROUP BY ALL)
SELECT b.page_id, b.host, b.path, f.rule, coalesce(f.verdict,
       CASE WHEN EXISTS (SELECT 1 FROM unnest([{_LISTED}]) AS t(x) WHERE b.host = x OR ends_with(b.host, '.' || x)) THEN 'block' ELSE 'allow' END) AS verdict
FROM b LEFT JOIN f ON b.page_id = f.page_id AND b.host = f.host AND b.path = f.path""",
    "op10_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, unnest({_shingles(5)}) AS x FROM d),
b AS (SELECT item_id, {_WORDS.format(text=_LOWER)} AS w FROM benchmark),
i AS (SELECT item_id, {_shingles(5)} AS g FROM b),
j AS (SELECT item_id, len(g) AS n, unnest(g) AS x FROM i),
m AS (SELECT doc_id, item_id FROM s JOIN j ON s.x = j.x GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n),
o AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS t
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, o.n IS NOT NULL AS contaminated, coalesce(o.n, 0) AS n_items, coalesce(o.t, '') AS item_ids
FROM documents AS d LEFT JOIN o ON d.doc_id = o.doc_id""",
    # crc32 by its table; a letter beyond U+007F has two bytes
    "op11_spelling_variants": r"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
o AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
u AS (SELECT doc_id, run, count(*) AS n FROM o GROUP BY ALL),
b AS (SELECT run, n, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + unicode(c) % 64] END)) AS bytes FROM u),
c AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[1 + xor(c, x) % 256])), 4294967295) AS h FROM b, t),
x AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM c),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM x WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS other, b.n AS m FROM d AS a JOIN d AS b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM d AS a JOIN w AS b ON a.k = b.word
      UNION SELECT b.word, a.word, a.n FROM d AS a JOIN w AS b ON a.k = b.word),
s AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS form, max(m) AS form_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
      FROM w LEFT JOIN s ON w.word = s.word),
r AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT r.word, f.form, step + 1 FROM r JOIN f ON r.root = f.word WHERE f.form IS NOT NULL),
z AS (SELECT word, arg_max(root, step) AS root FROM r GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN z ON f.word = z.word""",
    "op12_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
u AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT u.lang, u.phrase, a, cut, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
      FROM u JOIN f AS x ON x.lang = u.lang AND x.phrase = array_to_string(list_slice(w, 1, cut), ' ')
             JOIN f AS y ON y.lang = u.lang AND y.phrase = array_to_string(list_slice(w, cut + 1, u.k), ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS pos FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k),
j AS (SELECT lang, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS phrase, max(a) AS longer FROM i GROUP BY ALL),
z AS (SELECT b.lang, b.phrase, a, l, r, score FROM b LEFT JOIN j ON b.lang = j.lang AND b.phrase = j.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN t ON o.lang = t.lang WHERE rank <= 2000""",
}
