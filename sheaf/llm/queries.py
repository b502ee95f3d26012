"""The registered queries of the operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import (
    alignment,
    decontam,
    langid,
    lattice,
    linededup,
    mixing,
    nearjoin,
    packing,
    quality,
    resampling,
    substring,
    suffix,
    tokencount,
)
from sheaf.llm.common import documents, word_count


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out() -> "F.Column":
    """Documents that no model learns from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out()))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


def op2_lines(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = linededup.dedup_lines(documents(spark, folder).select("doc_id", "text"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", digest)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = tokencount.read_pieces(tokenizer_file("piece_bpe_32k.model"))
    docs = documents(spark, folder).select("doc_id", "text")
    return tokencount.count_tokens(docs, pieces).select("doc_id", "n_words", "n_tokens", "score")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = documents(spark, folder).select("doc_id", "source", word_count("text").alias("size"))
    kinds = mixing.mix_sizes(sized)
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))
    return kinds.withColumn("row", each).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "source",
    )


def op5_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"), threshold=0.98)


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return nearjoin.near_duplicates(documents(spark, folder).select("doc_id", "text"), percent=85)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        documents(spark, folder).select("doc_id", "text"), tokenizer_file("word_bpe_49k.json")
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(documents(spark, folder)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def _digest(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op6_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return _digest(suffix.suffix_dedup(documents(spark, folder).select("doc_id", "text")))


def op10_substring(spark: SparkSession, folder: str) -> DataFrame:
    return _digest(substring.substring_dedup(documents(spark, folder).select("doc_id", "text")))


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontam.covered_words(documents(spark, folder).select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        decontam.hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_starts") > 0).alias("contaminated"),
    )


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    drawn = resampling.resample(docs, spark.read.parquet(f"{folder}/benchmark.parquet").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    aligned = alignment.align(documents(spark, folder).select("doc_id", "text"), a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links")
    return alignment.weigh_links(aligned, alignment.piece_count(b)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES = {
    "op1_language": op1_language,
    "op2_lines": op2_lines,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op6_suffix_array": op6_suffix_array,
    "op5_lattice": op5_lattice,
    "op7_minhash": op7_minhash,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_substring": op10_substring,
    "op11_decontamination": op11_decontamination,
    "op12_resampling": op12_resampling,
    "op13_alignment": op13_alignment,
}

SQL_WORDS = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

# The windows of 50 words, each with the smallest document it starts in; the words that windows of others cover go.
SQL_REPEATS = f"""WITH t AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
  FROM t, unnest(range(1, greatest(len(w) - 48, 1))) AS r(i)),
first AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM windows JOIN first USING (k), range(0, 50) AS s(o) WHERE d < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)"""

SQL_NEAR = rf"""WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS k
  FROM t, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (k)
  WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reached AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON a = r),
groups AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM groups LEFT JOIN sizes USING (doc_id)"""

SQL_VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
  AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reached AS (SELECT vec_id, vec_id AS r FROM v UNION SELECT vec_id, b FROM reached JOIN links ON a = r),
groups AS (SELECT vec_id, min(r) AS component_id FROM reached GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, component_id = vec_id AS kept
FROM groups LEFT JOIN counts USING (vec_id)"""


def sql_quality(rules=quality.DEFAULT_RULES) -> str:
    """The measures and the threshold table as SQL."""
    stop_words = ", ".join(f"'{w}', '{w}.'" for w in quality.STOP_WORDS)
    blank = r"[\x20\x09-\x0D]"
    count = lambda of, test: f"CAST(len(list_filter({of}, lambda x: {test})) AS BIGINT)"
    broken = []
    for rule in rules:
        tests = [f"{rule.measure} < {rule.low}"] if rule.low is not None else []
        tests += [f"{rule.measure} > {rule.high}"] if rule.high is not None else []
        broken.append(f"CASE WHEN {' OR '.join(tests)} THEN '{rule.name}' END")
    return rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM t, unnest(range(1, greatest(len(w) - 3, 1))) AS r(i)),
repeated AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM repeated, range(0, 5) AS s(o) GROUP BY 1),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '{blank}+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(l) AS n_lines, {count('w', f'lower(x) IN ({stop_words})')} AS n_stop, {count('w', r"regexp_matches(x, '\pL')")} AS n_letter,
  {count('l', f"regexp_matches(x, '^{blank}*[-*•–]')")} AS n_bullet,
  {count('l', rf"regexp_matches(x, '(\.\.\.|…){blank}*$')")} AS n_ellipsis FROM t LEFT JOIN covered USING (doc_id)),
ratios AS (SELECT *, word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(n_words, 0) AS symbol_ratio,
  n_stop / nullif(n_words, 0) AS stop_word_ratio, n_letter / nullif(n_words, 0) AS letter_word_ratio,
  n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio, n_bullet / nullif(n_lines, 0) AS bullet_line_ratio,
  n_ellipsis / nullif(n_lines, 0) AS ellipsis_line_ratio,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM (
  SELECT *, array_to_string(list_filter([{', '.join(broken)}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM ratios)"""


SQL_TERMS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

# Windows of ten words of an item, or a shorter one whole; the words that they cover in documents.
SQL_COVERED = f"""WITH t AS (SELECT doc_id, {SQL_TERMS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {SQL_TERMS} AS w FROM benchmark),
strings AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS k, least(len(w), 10) AS n
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS r(i) WHERE len(w) > 0),
windows AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM t, (SELECT DISTINCT n FROM strings), unnest(range(1, len(w) - n + 2)) AS r(i)),
found AS (SELECT doc_id, i, n, item_id FROM windows JOIN strings USING (k, n)),
hit AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM found, unnest(range(0, n)) AS s(o) GROUP BY 1),
own AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS l FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM t LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""

# CRC-32 goes byte by byte over the hexadecimal form of each distinct feature.
SQL_DRAWN = f"""WITH t AS (SELECT doc_id, {SQL_TERMS} AS w FROM documents),
b AS (SELECT {SQL_TERMS} AS w FROM benchmark),
f AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM t),
g AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM b),
crc AS (SELECT list_transform(range(0, 256), lambda v: list_reduce(range(0, 8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END, v)) AS e),
hexed AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM f UNION SELECT x FROM g)),
hashed AS (SELECT x, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
  lambda c, v: xor(c >> 8, e[(xor(c, v) & 255) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 10000 AS bucket FROM hexed, crc),
s AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS s FROM f JOIN hashed USING (x) GROUP BY 1),
u AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS u FROM g JOIN hashed USING (x) GROUP BY 1),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(u, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
  / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(u), 0) FROM u) + 10000)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN u USING (bucket)),
weights AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN hashed USING (x) JOIN gains USING (bucket) GROUP BY 1),
scored AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
  / 4294967296))) AS BIGINT) AS score FROM t LEFT JOIN weights USING (doc_id)),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT scored.doc_id, n_features, weight, score, CAST(rank AS BIGINT) AS rank
FROM scored LEFT JOIN drawn ON drawn.doc_id = scored.doc_id AND rank <= 25 * n // 100"""


SQL: dict[str, str] = {
    "op5_lattice": SQL_VECTORS,
    "op6_suffix_array": SQL_REPEATS,
    "op7_minhash": SQL_NEAR,
    "op9_quality": sql_quality(),
    "op10_substring": SQL_REPEATS,
    "op11_decontamination": SQL_COVERED,
    "op12_resampling": SQL_DRAWN,
}
