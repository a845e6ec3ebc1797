"""

In the queries ``documents.source`` plays the file and ``doc_id`` the line order. Queries on files
first let Spark write the table out as files in the shared folder.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ctxloom.functions.encoders import encode_bytes, encode_word_hash, word_count  # noqa: E402
from ctxloom.functions.keys import assign_cells  # noqa: E402
from ctxloom.functions.keys import shuffle_key as add_key  # noqa: E402
from ctxloom.functions.presets import LLAMA3, NEOX, all_presets, preset  # noqa: E402
from ctxloom.operators.accounting import preset_accounting as per_preset  # noqa: E402
from ctxloom.operators.accounting import stats_from_totals, token_stats  # noqa: E402
from ctxloom.operators.cascade import cascade_shards  # noqa: E402
from ctxloom.operators.encode import encode_corpus, load_hf_vocab, load_rank_vocab  # noqa: E402
from ctxloom.operators.framing import frame_tokens  # noqa: E402
from ctxloom.operators.offsets import stream_offsets  # noqa: E402
from ctxloom.operators.packing import context_spans, pack_contexts  # noqa: E402
from ctxloom.operators.pretokenize import pretoken_counts, pretokenize  # noqa: E402
from ctxloom.operators.shuffle import (  # noqa: E402
    assign_shards, enumerate_contexts, global_shuffle, locate_shards, shard_lookup,
)
from ctxloom.operators.streams import arrange_blocks, block_streams, pack_streams  # noqa: E402
from ctxloom.plans.shuffle_only import shuffle_shards  # noqa: E402
from ctxloom.plans.summary import run_summary  # noqa: E402
from ctxloom.plans.tokenize_shuffle import account_stage, encode_stage, shard_pieces, tokenize_shuffle  # noqa: E402
from ctxloom.runtime import parallelism, scratch_path, spread_small  # noqa: E402
from ctxloom.sinks.line_files import write_line_files  # noqa: E402
from ctxloom.sources.documents import check_records, read_documents, read_lines  # noqa: E402
from ctxloom.sources.listing import dataset_size, list_corpus  # noqa: E402
from ctxloom.sources.manifest import manifest_rows, manifest_tokens, read_manifest  # noqa: E402
from ctxloom.sources.paths import write_small  # noqa: E402
from ctxloom.sources.ranks import read_ranks  # noqa: E402
from ctxloom.sources.shards import decode_contexts, index_shards, read_shards  # noqa: E402

SEED = 1234
SEQLEN = 2049
SHORT = 128  # context length of the shuffle queries: enough contexts at small scale
CHUNK = 64
CELLS = 128
ROWS_PER_FILE = 64
VOCAB_WORDS = 50000  # about what a published vocabulary has
RULES = preset(NEOX, "hf")


# ---------------------------------------------------------------- shared pieces


def _table(spark: SparkSession, sf: str) -> DataFrame:
    """The documents; one without a text counts as empty."""
    return spark.read.parquet(f"{sf}/documents.parquet").withColumn("text", F.coalesce("text", F.lit("")))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    table = _table(spark, sf)
    return spread_small(table.select(F.col("source").alias("file"), F.col("doc_id").alias("ord"), "text"))


def _lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Framed lengths without a token in sight: (file, ord, n)."""
    return _documents(spark, sf).select("file", "ord", (word_count(F.col("text")) + 1).cast("bigint").alias("n"))


def _framed(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    n = (word_count(F.col("text")) + 1).cast("bigint")
    docs = docs.select("file", "ord", encode_word_hash(F.col("text")).alias("tokens"), n.alias("n"))
    return frame_tokens(docs, RULES)


def _counts(spark: SparkSession, sf: str, seqlen: int = SHORT) -> DataFrame:
    """(file, docs, total, ...) accounting, one row per file."""
    totals = _lengths(spark, sf).groupBy("file").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").cast("bigint").alias("total")
    )
    return stats_from_totals(totals, RULES, seqlen, total_row=False)


def _contexts(spark: SparkSession, sf: str) -> DataFrame:
    """(file, ctx) of every context; ids come from counts alone."""
    return enumerate_contexts(_counts(spark, sf).select("file", "contexts"))


def _token_md5(tokens: str = "tokens") -> Column:
    return F.md5(F.array_join(tokens, ","))


def _hashed(contexts: DataFrame) -> DataFrame:
    return contexts.select("file", "ctx", F.col("n_real").cast("bigint"), _token_md5().alias("tokens_md5"))


def _file_number() -> Column:
    return F.call_function("div", F.col("doc_id"), F.lit(ROWS_PER_FILE))


def _corpus_files(spark: SparkSession, sf: str) -> str:
    """The documents as gzipped JSON lines, a fixed number of rows per file."""
    path = scratch_path(spark, "corpus")
    table = _table(spark, sf)
    line = F.to_json(F.struct("doc_id", "text", "lang"))
    rows = table.select(_file_number().alias("no"), "doc_id", line.alias("line"))
    rows = rows.repartition(parallelism(spark), "no").sortWithinPartitions("no", "doc_id")
    name = F.concat(F.lit("no="), F.coalesce(F.col("no").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    write_line_files(rows.select(name.alias("name"), "line"), path, "part.json.gz")
    return path


def _number_in(path: Column) -> Column:
    return F.regexp_extract(path, r"/no=(\d+)/", 1)


def _job(spark: SparkSession, sf: str, **options):
    """Run the whole job on the corpus files; (folder of shards, result)."""
    out = scratch_path(spark, "shards")
    result = tokenize_shuffle(
        spark, _corpus_files(spark, sf), out, encode_word_hash, seqlen=SHORT, chunk_size=CHUNK, seed=SEED,
        ext=".json.gz", name_of=_number_in, **options,
    )
    return out, result


def _shard_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, idx, tokens_md5) of written shards; numbers from the member names."""
    rows = decode_contexts(read_shards(spark, folder))
    part = F.split("name", "_")
    return rows.select(
        part[0].cast("bigint").alias("shard"), part[1].cast("bigint").alias("idx"), _token_md5().alias("tokens_md5")
    )


def _frequent_words(spark: SparkSession, sf: str) -> list[str]:
    """The vocabulary's words: frequent pre-tokens of three bytes and more."""
    words = pretoken_counts(_documents(spark, sf)).filter("octet_length(word) >= 3")
    return [r.word for r in words.orderBy(F.desc("n"), "word").limit(VOCAB_WORDS).collect()]


def _rank_vocab(spark: SparkSession, sf: str):
    """256 bytes and the corpus' frequent pre-tokens, written as a rank file and loaded."""
    tokens = [bytes([i]) for i in range(256)] + [w.encode() for w in _frequent_words(spark, sf)]
    path = scratch_path(spark, "vocab") + ".ranks"
    write_small(path, "".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)).encode())
    return load_rank_vocab(spark, path)


def _hf_vocab(spark: SparkSession, sf: str):
    import tokenizers

    words = (
        _documents(spark, sf)
        .select(F.explode(F.array_remove(F.split("text", " "), "")).alias("word"))
        .filter(~F.col("word").rlike(r"(?U)\s"))
        .groupBy("word").count().orderBy(F.desc("count"), "word").limit(VOCAB_WORDS)
    )
    ids = {"[UNK]": 0, **{r.word: i + 1 for i, r in enumerate(words.collect())}}
    tok = tokenizers.Tokenizer(tokenizers.models.WordLevel(ids, unk_token="[UNK]"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.Split(" ", "removed")
    path = scratch_path(spark, "vocab") + ".json"
    write_small(path, tok.to_str().encode())
    return load_hf_vocab(spark, path)


# ---------------------------------------------------------------- sources


def corpus_listing(spark: SparkSession, sf: str) -> DataFrame:
    path = _plain_files(spark, sf)
    return list_corpus(spark, path, ".txt").select(_number_in(F.col("file")).cast("bigint").alias("no"), "bytes")


def output_size(spark: SparkSession, sf: str) -> DataFrame:
    return dataset_size(spark, _plain_files(spark, sf))


def _plain_files(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "plain")
    table = _table(spark, sf)
    rows = table.select(_file_number().alias("no"), F.concat("doc_id", F.md5("text")).alias("value"))
    rows.repartition("no").write.partitionBy("no").text(path)
    return path


def doc_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files of at most ROWS_PER_FILE lines, so numbering lines per file stays small."""
    from pyspark.sql import Window

    docs = read_documents(spark, _corpus_files(spark, sf), ".json.gz")
    line = F.row_number().over(Window.partitionBy("file").orderBy("block", "ord"))
    return docs.select(
        _number_in(F.col("file")).cast("bigint").alias("no"), line.cast("bigint").alias("line"), F.md5("text").alias("text_md5")
    )


def record_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a line, most of them spoilt in one of several ways."""
    path = scratch_path(spark, "lines")
    table = _table(spark, sf)
    good = F.to_json(F.struct("text", "lang"))
    kind = F.pmod("doc_id", F.lit(10))
    line = (
        F.when(kind == 0, F.concat(good, F.lit(" x")))
        .when(kind == 1, F.expr("left(to_json(struct(text, lang)), length(to_json(struct(text, lang))) - 1)"))
        .when(kind == 2, F.to_json(F.struct(F.col("text").alias("body"))))
        .when(kind == 3, F.lit('{"text":null}'))
        .when(kind == 4, F.to_json(F.struct(F.col("n_chars").alias("text"))))
        .when(kind == 5, F.concat(F.lit("["), good, F.lit("]")))
        .when(kind == 6, F.lit(""))
        .otherwise(good)
    )
    table.select(line.alias("value")).write.text(path)
    checked = check_records(read_lines(spark, path, ".txt"))
    return checked.groupBy(F.coalesce("reason", F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("bigint").alias("text_bytes")
    )


def shard_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder, _ = _job(spark, sf)
    rows = read_shards(spark, folder)
    return rows.groupBy(F.regexp_extract("src", r"(shard_\d+)\.tar$", 1).alias("shard")).agg(
        F.count(F.lit(1)).alias("members"), F.max("pos").alias("last_pos")
    )


def shard_index(spark: SparkSession, sf: str) -> DataFrame:
    folder, _ = _job(spark, sf)
    ranges = index_shards(spark, folder, range_bytes=8192)
    return ranges.groupBy(F.regexp_extract("src", r"(shard_\d+)\.tar$", 1).alias("shard")).agg(
        F.sum("members").cast("bigint").alias("members")
    )


def rank_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus' distinct words as a rank file, read back."""
    path = scratch_path(spark, "ranks")
    words = _documents(spark, sf).select(F.explode(F.array_remove(F.split("text", " "), "")).alias("w")).distinct()
    rank = F.conv(F.substring(F.md5("w"), 1, 7), 16, 10)
    words.select(F.concat(F.regexp_replace(F.base64(F.encode("w", "UTF-8")), r"\s", ""), F.lit(" "), rank)).write.text(path)
    return read_ranks(spark, path).select(F.md5("token").alias("token_md5"), F.col("rank").cast("bigint").alias("rank"))


def manifest_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder, _ = _job(spark, sf)
    return read_manifest(spark, folder)


# ---------------------------------------------------------------- documents to tokens


def pretokenize_neox(spark: SparkSession, sf: str) -> DataFrame:
    return _pretokens(spark, sf, "neox")


def pretokenize_llama3(spark: SparkSession, sf: str) -> DataFrame:
    return _pretokens(spark, sf, "llama3")


def _pretokens(spark: SparkSession, sf: str, pattern: str) -> DataFrame:
    words = pretokenize(_documents(spark, sf), pattern)
    return words.select(
        "ord", F.size("words").cast("bigint").alias("n"), F.md5(F.array_join("words", "|")).alias("words_md5")
    )


def pretoken_table(spark: SparkSession, sf: str) -> DataFrame:
    return pretoken_counts(_documents(spark, sf))


def encode_partition(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encode_corpus(_documents(spark, sf), _rank_vocab(spark, sf)))


def encode_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encode_corpus(_documents(spark, sf), _rank_vocab(spark, sf), plan="dictionary"))


def encode_hf(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(encode_corpus(_documents(spark, sf), _hf_vocab(spark, sf)))


def _encoded(df: DataFrame) -> DataFrame:
    return df.select("ord", F.size("tokens").cast("bigint").alias("n"), _token_md5().alias("tokens_md5"))


def encode_utf8(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(_documents(spark, sf).select("ord", encode_bytes(F.col("text")).alias("tokens")))


def encode_words(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(_documents(spark, sf).select("ord", encode_word_hash(F.col("text")).alias("tokens")))


def frame_llama3(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("ord", encode_word_hash(F.col("text")).alias("tokens"))
    return _encoded(frame_tokens(docs, preset(LLAMA3, "ranks")))


def preset_accounting(spark: SparkSession, sf: str) -> DataFrame:
    counts = _counts(spark, sf).select("file", "docs", "text_tokens")
    return per_preset(counts, all_presets(), SEQLEN)


# ---------------------------------------------------------------- tokens to contexts


def token_count_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return _lengths(spark, sf).groupBy("file").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n").cast("bigint").alias("tokens")
    )


def stream_spans(spark: SparkSession, sf: str) -> DataFrame:
    return stream_offsets(_lengths(spark, sf)).select("file", "ord", "b", "e")


def context_lineage(spark: SparkSession, sf: str) -> DataFrame:
    spans = context_spans(stream_offsets(_lengths(spark, sf)), SHORT)
    return spans.select("file", "ord", "ctx", F.col("offset").cast("bigint"), "doc_offset", F.col("len").cast("bigint"))


def packed_contexts(spark: SparkSession, sf: str) -> DataFrame:
    return _hashed(pack_contexts(_framed(spark, sf), SEQLEN, RULES.pad, n="n"))


def packed_per_document(spark: SparkSession, sf: str) -> DataFrame:
    """Every document a file of its own: many tails, some of them all padding."""
    docs = _framed(spark, sf).withColumn("file", F.col("ord").cast("string"))
    return _hashed(pack_contexts(docs, 16, RULES.pad, n="n"))


def packed_streams(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("file", "ord", encode_word_hash(F.col("text")).alias("tokens"))
    streams = block_streams(arrange_blocks(docs), RULES, SEQLEN)
    return _hashed(pack_streams(streams, SEQLEN, RULES.pad))


def token_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return token_stats(_lengths(spark, sf), RULES, SEQLEN)


# ---------------------------------------------------------------- shuffle and shards


def shuffle_keys(spark: SparkSession, sf: str) -> DataFrame:
    return add_key(_contexts(spark, sf), SEED)


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return assign_cells(_contexts(spark, sf), CELLS, SEED).drop("key")


def global_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return global_shuffle(_contexts(spark, sf), SEED).drop("key")


def shard_places(spark: SparkSession, sf: str) -> DataFrame:
    ranked = assign_shards(global_shuffle(_contexts(spark, sf), SEED), CHUNK)
    return ranked.select("file", "ctx", "shard", F.col("idx").cast("bigint"))


def shard_borders(spark: SparkSession, sf: str) -> DataFrame:
    lookup = shard_lookup(_counts(spark, sf).select("file", "contexts"), SEED, CHUNK)
    return locate_shards(add_key(_contexts(spark, sf), SEED), lookup, True).drop("key")


def cascade_places(spark: SparkSession, sf: str) -> DataFrame:
    placed = cascade_shards(_contexts(spark, sf), CELLS, CHUNK, SEED)
    return placed.select(
        "file", "ctx", F.col("round").cast("bigint"), "cell", "blk", F.col("idx").cast("bigint"), "shard"
    )


def sharded_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: encode, pack, shuffle and place every context, without writing the tars."""
    work = scratch_path(spark, "flagship")
    docs = arrange_blocks(_documents(spark, sf))
    streams = encode_stage(docs, encode_word_hash, RULES, SHORT, f"{work}/streams")
    totals, per_file = account_stage(streams, RULES, SHORT, work)
    ready = shard_pieces(streams, totals, per_file, RULES, SHORT, CHUNK, SEED).rows
    parts = F.array_sort(F.collect_list(F.struct("offset", "tokens")))
    joined = ready.groupBy("shard", "name").agg(F.flatten(F.transform(parts, lambda p: p["tokens"])).alias("tokens"))
    return joined.select("shard", "name", _token_md5().alias("tokens_md5"))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest_rows(assign_shards(global_shuffle(_contexts(spark, sf), SEED), CHUNK))


def token_total(spark: SparkSession, sf: str) -> DataFrame:
    return manifest_tokens(manifest(spark, sf), SHORT)


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return run_summary(_counts(spark, sf), manifest(spark, sf), CHUNK)


# ---------------------------------------------------------------- jobs


def tokenize_shuffle_job(spark: SparkSession, sf: str) -> DataFrame:
    folder, _ = _job(spark, sf)
    return _shard_rows(spark, folder)


def tokenize_shuffle_cells(spark: SparkSession, sf: str) -> DataFrame:
    folder, _ = _job(spark, sf, shuffle="cells", n_cells=CELLS)
    return _shard_rows(spark, folder)


def shuffle_only_job(spark: SparkSession, sf: str) -> DataFrame:
    folder, _ = _job(spark, sf)
    again = scratch_path(spark, "reshuffled")
    shuffle_shards(spark, folder, again, seqlen=SHORT, chunk_size=CHUNK // 2, seed=SEED + 1)
    return _shard_rows(spark, again)


def dataset_card(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "card")
    write_small(f"{base}/in.json", b'{"name": "documents", "tokenized": false}')
    _job(spark, sf, input_json=f"{base}/in.json", output_json=f"{base}/out.json")
    card = spark.read.option("multiLine", "true").json(f"{base}/out.json")
    return card.select("name", "tokenized", "tokenizer", "num_tokens", (F.col("size") > 0).alias("has_size"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    corpus_listing, output_size, doc_scan, record_checks, shard_scan, shard_index, rank_scan, manifest_scan,
    pretokenize_neox, pretokenize_llama3, pretoken_table, encode_partition, encode_dictionary, encode_hf,
    encode_utf8, encode_words, frame_llama3, preset_accounting, token_count_by_source, stream_spans,
    context_lineage, packed_contexts, packed_per_document, packed_streams, token_accounts, shuffle_keys, cells,
    global_ranks, shard_places, shard_borders, cascade_places, sharded_contexts, manifest, token_total, summary,
    tokenize_shuffle_job, tokenize_shuffle_cells, shuffle_only_job, dataset_card,
]


def entry(spark: SparkSession) -> DataFrame:
    return sharded_contexts(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {query.__name__: query for query in QUERIES}
    if _present("ctxloom.llm"):
        from ctxloom.llm.queries import llm_queries

        own |= llm_queries()
    if _present("ctxloom.llm") and _present("corpus_pipeline"):
        import corpus_pipeline

        own["pipeline"] = corpus_pipeline.run
    return own


def _present(module: str) -> bool:
    """Whether a part that can be left out is there. A bare folder, such as one of old byte code, is not."""
    found = importlib.util.find_spec(module)
    return found is not None and found.origin is not None


# ---------------------------------------------------------------- oracles

_TABLE = "(SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)"
_DOCS = f"SELECT source AS file, doc_id AS ord, text FROM {_TABLE}"
_BY_NUMBER = f"SELECT (doc_id // {ROWS_PER_FILE})::VARCHAR AS file, doc_id AS ord, text FROM {_TABLE}"
_BY_DOC = f"SELECT doc_id::VARCHAR AS file, doc_id AS ord, text FROM {_TABLE}"
_WORDS = "list_filter(string_split(text, ' '), lambda w: w <> '')"
_HASHED = f"list_transform({_WORDS}, lambda w: ('0x' || substr(md5(w), 1, 4))::BIGINT % 50000 + 1)"
_HEX = "regexp_extract_all(hex(encode({})), '..')"
_BYTES = "list_transform(" + _HEX + ", lambda h: ('0x' || h)::BIGINT)"


def _list_md5(expr: str) -> str:
    return f"md5(array_to_string({expr}, ','))"


def _contexts_sql(docs: str, seqlen: int, pad: int = RULES.pad) -> str:
    """CTEs up to ``contexts(file, ctx, n_real, tokens_md5)``, token by token."""
    return f"""
      docs AS ({docs}),
      flat AS (SELECT file, ord, unnest(list_append({_HASHED}, 0)) AS tok,
                      generate_subscripts(list_append({_HASHED}, 0), 1) AS i FROM docs),
      placed AS (SELECT file, tok, row_number() OVER (PARTITION BY file ORDER BY ord, i) - 1 AS pos, 1 AS is_real
                 FROM flat),
      totals AS (SELECT file, count(*) AS total FROM placed GROUP BY file),
      padding AS (SELECT file, {pad} AS tok, total - total % {seqlen} + unnest(range(total % {seqlen}, {seqlen})) AS pos,
                         0 AS is_real FROM totals),
      contexts AS (SELECT file, pos // {seqlen} AS ctx, sum(is_real)::BIGINT AS n_real,
                          md5(string_agg(tok::VARCHAR, ',' ORDER BY pos)) AS tokens_md5
                   FROM (SELECT * FROM placed UNION ALL SELECT file, tok, pos, is_real FROM padding)
                   GROUP BY file, pos // {seqlen})"""


_LENGTHS = f"SELECT file, ord, len({_WORDS}) + 1 AS n FROM ({_DOCS})"
_OFFSETS = (
    "SELECT file, ord, (sum(n) OVER w - n)::BIGINT AS b, (sum(n) OVER w)::BIGINT AS e, n "
    f"FROM ({_LENGTHS}) WINDOW w AS (PARTITION BY file ORDER BY ord)"
)


def _ids_sql(seqlen: int = SHORT) -> str:
    """CTE ``ids(file, ctx, key)``: contexts by count alone."""
    return f"""
      lengths AS ({_LENGTHS}),
      per_file AS (SELECT file, count(*) AS docs, sum(n)::BIGINT AS total FROM lengths GROUP BY file),
      pairs AS (SELECT file, unnest(range(0, total // {seqlen} + 1)) AS ctx FROM per_file),
      ids AS (SELECT file, ctx, md5('{SEED}|' || file || '|' || ctx) AS key FROM pairs),
      ranked AS (SELECT file, ctx, key, row_number() OVER (ORDER BY key, file, ctx) - 1 AS rank FROM ids)"""


def _cascade_sql(ids: str) -> str:
    """CTEs of the three rounds for 128, 8 and 1 cells, up to ``cascade``."""

    def draw(column: str, n: int) -> str:
        return f"('0x' || substr({column}, 9, 8))::BIGINT % {n}"

    def one_round(no: int, n: int, source: str) -> str:
        digits = "key" if no == 0 else f"md5('{SEED}|round{no}|' || key)"
        full = "TRUE" if n == 1 else f"r < size - size % {CHUNK}"
        return f"""
      cell{no} AS (SELECT file, ctx, key, {draw(digits, n)} AS cell FROM {source}),
      rank{no} AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY key, file, ctx) - 1 AS r,
                          count(*) OVER (PARTITION BY cell) AS size FROM cell{no}),
      done{no} AS (SELECT {no} AS round, * FROM rank{no} WHERE {full}),
      left{no} AS (SELECT file, ctx, key FROM rank{no} WHERE NOT ({full}))"""

    rounds = [one_round(0, 128, ids), one_round(1, 8, "left0"), one_round(2, 1, "left1")]
    return ",".join(rounds) + f""",
      done AS (SELECT file, ctx, key, round, cell, r // {CHUNK} AS blk, r % {CHUNK} AS idx FROM
               (SELECT * FROM done0 UNION ALL SELECT * FROM done1 UNION ALL SELECT * FROM done2)),
      cascade AS (SELECT *, dense_rank() OVER (ORDER BY round, cell, blk) - 1 AS shard FROM done)"""


# Regular expressions without look-ahead: a marker is set before the last blank of each run that a
# visible character follows, the very blank that look-ahead would leave to the next word.
_MARK = "chr(1)"
_SP = r"\x09-\x0d \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_MARKED = f"regexp_replace(text, '([{_SP}])([^{_SP}])', {_MARK} || '\\1\\2', 'g')"
_SPLIT = {
    "neox": (
        rf"\x01?(?:'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SP}\p{{L}}\p{{N}}\x01]+|[{_SP}]+)"
    ),
    "llama3": (
        rf"\x01?(?:(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{{L}}\p{{N}}\x01]?\p{{L}}+|\p{{N}}{{1,3}}"
        rf"| ?[^{_SP}\p{{L}}\p{{N}}\x01]+[\r\n]*(?:\x01[\r\n]+)?|[{_SP}]*(?:\x01?[\r\n])+|[{_SP}]+)"
    ),
}


def _split_sql(pattern: str) -> str:
    regex = _SPLIT[pattern].replace("'", "''")
    return f"list_transform(regexp_extract_all({_MARKED}, '{regex}'), lambda w: replace(w, {_MARK}, ''))"


_TOP_WORDS = f"""
      words AS (SELECT unnest({_split_sql("neox")}) AS word FROM ({_DOCS})),
      vocab AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) + 255 AS id FROM words
                WHERE octet_length(encode(word)) >= 3 GROUP BY word
                ORDER BY count(*) DESC, word LIMIT {VOCAB_WORDS})"""
_RANK_ENCODED = f"""
    WITH {_TOP_WORDS},
      spread AS (SELECT ord, unnest({_split_sql("neox")}) AS word,
                        generate_subscripts({_split_sql("neox")}, 1) AS i FROM ({_DOCS})),
      coded AS (SELECT ord, i, CASE WHEN id IS NULL THEN {_BYTES.format("word")} ELSE [id] END AS ids
                FROM spread LEFT JOIN vocab USING (word)),
      joined AS (SELECT ord, flatten(list(ids ORDER BY i)) AS tokens FROM coded GROUP BY ord)
    SELECT ord, len(coalesce(tokens, [])) AS n, {_list_md5("coalesce(tokens, [])")} AS tokens_md5
    FROM ({_DOCS}) LEFT JOIN joined USING (ord)"""
_NO_BLANK = f"NOT regexp_matches(word, '[{_SP}]')"
_HF_ENCODED = f"""
    WITH words AS (SELECT unnest({_WORDS}) AS word FROM ({_DOCS})),
      vocab AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS id FROM words
                WHERE {_NO_BLANK} GROUP BY word ORDER BY count(*) DESC, word LIMIT {VOCAB_WORDS}),
      spread AS (SELECT ord, unnest({_WORDS}) AS word, generate_subscripts({_WORDS}, 1) AS i FROM ({_DOCS})),
      joined AS (SELECT ord, list(coalesce(id, 0) ORDER BY i) AS tokens
                 FROM spread LEFT JOIN vocab USING (word) GROUP BY ord)
    SELECT ord, len(coalesce(tokens, [])) AS n, {_list_md5("coalesce(tokens, [])")} AS tokens_md5
    FROM ({_DOCS}) LEFT JOIN joined USING (ord)"""


def _pretoken_sql(pattern: str) -> str:
    return f"""
    SELECT ord, len(words) AS n, md5(array_to_string(words, '|')) AS words_md5
    FROM (SELECT ord, {_split_sql(pattern)} AS words FROM ({_DOCS}))"""


def _encoded_sql(tokens: str) -> str:
    return f"SELECT ord, len({tokens}) AS n, {_list_md5(tokens)} AS tokens_md5 FROM ({_DOCS})"


def _account_columns(total: str, docs: str, seqlen: int) -> str:
    return f"""{docs} AS docs, {total} - {docs} AS text_tokens, {docs} AS eot_tokens, 0::BIGINT AS bos_tokens,
           ({total} // {seqlen} + 1) * {seqlen} - {total} AS pad_tokens, {total} // {seqlen} + 1 AS contexts,
           ({total} // {seqlen} + 1) * {seqlen} AS token_count"""


# Fixed values, stated here again so that the check does not rest on the presets that it checks.
_PRESETS = """(VALUES
    ('EleutherAI/gpt-neox-20b', 'hf', 50254, 0, 50256, NULL),
    ('EleutherAI/gpt-neox-20b', 'ranks', 50254, 0, 50256, NULL),
    ('meta-llama/Meta-Llama-3-8B', 'hf', 128256, 0, 128258, NULL),
    ('meta-llama/Meta-Llama-3-8B', 'ranks', 128256, 0, 128258, 128000)
) AS p(tokenizer, backend, vocab, eot, pad, bos)"""


# Contexts of the file-based jobs with their place: shard, idx.
_JOB = f"""
    WITH {_contexts_sql(_BY_NUMBER, SHORT)},
      keyed AS (SELECT *, md5('{SEED}|' || file || '|' || ctx) AS key FROM contexts)"""
_JOB_PLACED = f"""{_JOB},
      placed1 AS (SELECT *, row_number() OVER (ORDER BY key) - 1 AS rank FROM keyed),
      sharded AS (SELECT rank // {CHUNK} AS shard, rank % {CHUNK} AS idx, tokens_md5, key FROM placed1)"""


def oracle_sql() -> dict[str, str]:
    own = _own_oracles()
    if _present("ctxloom.llm"):
        from ctxloom.llm.sql import llm_sql

        own |= llm_sql()
    if _present("ctxloom.llm") and _present("corpus_pipeline"):
        import corpus_pipeline

        if corpus_pipeline.ORACLE_SQL is not None:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own


def _own_oracles() -> dict[str, str]:
    account_sums = ", ".join(
        f"sum({c})::BIGINT AS {c}"
        for c in ("docs", "text_tokens", "eot_tokens", "bos_tokens", "pad_tokens", "contexts", "token_count")
    )
    return {
        "corpus_listing": f"""
            SELECT doc_id // {ROWS_PER_FILE} AS no, sum(length(doc_id::VARCHAR) + 33)::BIGINT AS bytes
            FROM {_TABLE} GROUP BY 1""",
        "output_size": f"SELECT sum(length(doc_id::VARCHAR) + 33)::BIGINT AS size FROM {_TABLE}",
        "doc_scan": f"""
            SELECT doc_id // {ROWS_PER_FILE} AS no,
                   row_number() OVER (PARTITION BY doc_id // {ROWS_PER_FILE} ORDER BY doc_id) AS line,
                   md5(text) AS text_md5 FROM {_TABLE}""",
        "record_checks": f"""
            SELECT CASE doc_id % 10 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'not a JSON object'
                   WHEN 2 THEN 'missing text' WHEN 3 THEN 'null text' WHEN 4 THEN 'text is not a string'
                   WHEN 5 THEN 'not a JSON object' WHEN 6 THEN 'blank' ELSE 'good' END AS outcome,
                   count(*) AS n,
                   coalesce(sum(CASE WHEN doc_id % 10 >= 7 THEN octet_length(encode(text)) END), 0)::BIGINT AS text_bytes
            FROM {_TABLE} GROUP BY 1""",
        "shard_scan": f"""{_JOB_PLACED}
            SELECT 'shard_' || lpad(shard::VARCHAR, 8, '0') AS shard, count(*) AS members, max(idx) AS last_pos
            FROM sharded GROUP BY 1""",
        "shard_index": f"""{_JOB_PLACED}
            SELECT 'shard_' || lpad(shard::VARCHAR, 8, '0') AS shard, count(*) AS members FROM sharded GROUP BY 1""",
        "rank_scan": f"""
            SELECT DISTINCT md5(w) AS token_md5, ('0x' || substr(md5(w), 1, 7))::BIGINT AS rank
            FROM (SELECT unnest({_WORDS}) AS w FROM ({_DOCS}))""",
        "manifest_scan": f"""{_JOB_PLACED}
            SELECT 'shard_' || lpad(shard::VARCHAR, 8, '0') AS shard, count(*) AS num_sequences FROM sharded GROUP BY 1""",
        "pretokenize_neox": _pretoken_sql("neox"),
        "pretokenize_llama3": _pretoken_sql("llama3"),
        "pretoken_table": f"""
            SELECT word, count(*) AS n FROM (SELECT unnest({_split_sql("neox")}) AS word FROM ({_DOCS})) GROUP BY word""",
        "encode_partition": _RANK_ENCODED,
        "encode_dictionary": _RANK_ENCODED,
        "encode_hf": _HF_ENCODED,
        "encode_utf8": _encoded_sql(_BYTES.format("text")),
        "encode_words": _encoded_sql(_HASHED),
        "frame_llama3": _encoded_sql(f"list_concat([128000], {_HASHED}, [0])"),
        "preset_accounting": f"""
            WITH counts AS (SELECT file, count(*) AS docs, sum(n)::BIGINT AS framed FROM ({_LENGTHS}) GROUP BY file),
              sized AS (SELECT file, p.*, docs, framed + CASE WHEN bos IS NULL THEN 0 ELSE docs END AS total
                        FROM counts, {_PRESETS})
            SELECT file, tokenizer, backend, vocab, eot, pad, bos, total // {SEQLEN} + 1 AS contexts,
                   (total // {SEQLEN} + 1) * {SEQLEN} - total AS pad_tokens,
                   (total // {SEQLEN} + 1) * {SEQLEN} - CASE WHEN bos IS NULL THEN 0 ELSE docs END AS token_count
            FROM sized""",
        "token_count_by_source": f"SELECT file, count(*) AS docs, sum(n)::BIGINT AS tokens FROM ({_LENGTHS}) GROUP BY file",
        "stream_spans": f"SELECT file, ord, b, e FROM ({_OFFSETS})",
        "context_lineage": f"""
            SELECT file, ord, ctx, greatest(ctx * {SHORT}, b) - ctx * {SHORT} AS "offset",
                   greatest(ctx * {SHORT}, b) - b AS doc_offset,
                   least((ctx + 1) * {SHORT}, e) - greatest(ctx * {SHORT}, b) AS len
            FROM (SELECT *, unnest(range(b // {SHORT}, (e - 1) // {SHORT} + 1)) AS ctx FROM ({_OFFSETS}))""",
        "packed_contexts": f"WITH {_contexts_sql(_DOCS, SEQLEN)} SELECT * FROM contexts",
        "packed_per_document": f"WITH {_contexts_sql(_BY_DOC, 16)} SELECT * FROM contexts",
        "packed_streams": f"WITH {_contexts_sql(_DOCS, SEQLEN)} SELECT * FROM contexts",
        "token_accounts": f"""
            WITH counts AS (SELECT file, count(*) AS d, sum(n)::BIGINT AS t FROM ({_LENGTHS}) GROUP BY file),
              per_file AS (SELECT file, {_account_columns("t", "d", SEQLEN)} FROM counts)
            SELECT * FROM per_file UNION ALL SELECT NULL, {account_sums} FROM per_file""",
        "shuffle_keys": f"WITH {_ids_sql()} SELECT * FROM ids",
        "cells": f"WITH {_ids_sql()} SELECT file, ctx, ('0x' || substr(key, 1, 8))::BIGINT % {CELLS} AS cell FROM ids",
        "global_ranks": f"WITH {_ids_sql()} SELECT file, ctx, rank FROM ranked",
        "shard_places": f"WITH {_ids_sql()} SELECT file, ctx, rank // {CHUNK} AS shard, rank % {CHUNK} AS idx FROM ranked",
        "shard_borders": f"WITH {_ids_sql()} SELECT file, ctx, rank // {CHUNK} AS shard FROM ranked",
        "cascade_places": f"""
            WITH {_ids_sql()}, {_cascade_sql("ids")}
            SELECT file, ctx, round::BIGINT AS round, cell, blk, idx, shard FROM cascade""",
        "sharded_contexts": f"""
            WITH {_contexts_sql(_DOCS, SHORT)},
              keyed AS (SELECT md5('{SEED}|' || file || '|' || ctx) AS key, tokens_md5 FROM contexts)
            SELECT (row_number() OVER (ORDER BY key) - 1) // {CHUNK} AS shard, key || '.json.gz' AS name, tokens_md5
            FROM keyed""",
        "manifest": f"""
            WITH {_ids_sql()}
            SELECT 'shard_' || lpad((rank // {CHUNK})::VARCHAR, 8, '0') AS shard, count(*) AS num_sequences
            FROM ranked GROUP BY 1""",
        "token_total": f"WITH {_ids_sql()} SELECT count(*) * {SHORT} AS num_tokens FROM ids",
        "summary": f"""
            WITH {_ids_sql()}, facts AS (SELECT {_account_columns("total", "docs", SHORT)} FROM per_file),
              sizes AS (SELECT count(*) AS n FROM ranked GROUP BY rank // {CHUNK})
            SELECT sum(docs)::BIGINT AS docs, sum(token_count)::BIGINT AS token_count, sum(contexts)::BIGINT AS contexts,
                   (SELECT count(*) FROM sizes) AS shards, (SELECT count(*) FROM sizes WHERE n < {CHUNK}) AS short_shards,
                   (SELECT count(*) FROM ids) AS num_sequences,
                   round(sum(pad_tokens)::DOUBLE / sum(token_count), 6) AS pad_share
            FROM facts""",
        "tokenize_shuffle_job": f"{_JOB_PLACED} SELECT shard, idx, tokens_md5 FROM sharded",
        "tokenize_shuffle_cells": f"{_JOB}, {_cascade_sql('keyed')} SELECT shard, idx, tokens_md5 FROM cascade JOIN keyed USING (key)",
        "shuffle_only_job": f"""{_JOB_PLACED},
              second AS (SELECT tokens_md5, md5('{SEED + 1}|shard_' || lpad(shard::VARCHAR, 8, '0') || '.tar|' || idx) AS key2
                         FROM sharded),
              placed2 AS (SELECT tokens_md5, row_number() OVER (ORDER BY key2) - 1 AS rank FROM second)
            SELECT rank // {CHUNK // 2} AS shard, rank % {CHUNK // 2} AS idx, tokens_md5 FROM placed2""",
        "dataset_card": f"""{_JOB}
            SELECT 'documents' AS name, TRUE AS tokenized, '{NEOX}' AS tokenizer, count(*) * {SHORT} AS num_tokens,
                   TRUE AS has_size FROM keyed""",
    }
