"""The queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import linked_tokens
from .binids import read_ids, write_ids
from .chunkdedup import exact_duplicates
from .common import crc_fold, operator
from .fertility import judged
from .hmm import scored
from .hyperlang import identified, learn
from .linefreq import without_boilerplate
from .minhash import near_duplicates
from .packing import packed
from .postings import contaminated
from .segbpe import round_trip
from .tandem import periodic_runs, with_planted_runs
from .warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of all documents."""
    return judged(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from three quarters of them."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = learn(docs, train=crc_fold("doc_id", 4) != 2)
    return identified(docs, profiles).select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@operator
def op3_ranked_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids by way of frequency-ranked variable-length files."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return read_ids(write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0))


@operator
def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents on over 10 % of their source's documents, and the texts without them."""
    out = without_boilerplate(_table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@operator
def op5_segmented_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages by way of WARC archives."""
    read = read_archives(write_archives(_table(spark, sf_dir, "pages", "page_id", "url", "html")))
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


def op6_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return exact_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learnt from six sevenths of them."""
    out = scored(_table(spark, sf_dir, "documents", "doc_id", "text"), train_on=crc_fold("doc_id", 7) != 2)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents, at a similarity of 0.85 of 5-word shingles."""
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


def op9_least_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids packed into sequences of 2,048."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1)


def op10_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by a segment tree and decoded again."""
    return round_trip(_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside passages of ten words of the benchmark."""
    return contaminated(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_group_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two vocabularies over all documents."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return linked_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_tandem_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which repeat themselves."""
    return periodic_runs(_table(spark, sf_dir, "documents", "doc_id", "text"), rewrite=with_planted_runs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tokeniser_fertility": op1_tokeniser_fertility,
    "op2_hyperdimensional_language": op2_hyperdimensional_language,
    "op3_ranked_bytes": op3_ranked_bytes,
    "op4_line_frequency": op4_line_frequency,
    "op5_segmented_archives": op5_segmented_archives,
    "op6_chunk_recipes": op6_chunk_recipes,
    "op7_hidden_markov": op7_hidden_markov,
    "op8_minhash": op8_minhash,
    "op9_least_squares_packing": op9_least_squares_packing,
    "op10_segment_tree": op10_segment_tree,
    "op11_positional_index": op11_positional_index,
    "op12_group_dictionary": op12_group_dictionary,
    "op13_tandem_repeats": op13_tandem_repeats,
}

SQL: dict[str, str] = {
    "op4_line_frequency": r"""
with pages as (select doc_id, source, coalesce(source, '') || '/' || (source is null) as host, text, string_split(text, chr(10)) as lines from documents),
cut as (select host, doc_id, unnest(list_distinct(list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(13))))) as line from pages),
totals as (select host, count(*) as total from pages group by host),
over as (select c.host, c.line from (select host, line, count(*) as pages from cut where line <> '' group by host, line) c join totals t using (host)
  where c.pages * 100 > t.total * 10),
listed as (select host, list(line) as bad from over group by host),
done as (select p.*, list_filter(p.lines, lambda x: not list_contains(coalesce(l.bad, []), trim(x, ' ' || chr(9) || chr(13)))) as final from pages p left join listed l using (host))
select doc_id, source, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(lines) - len(final), 0)::bigint as n_dropped,
  sha256(coalesce(array_to_string(final, chr(10)), '')) as text_sha256 from done""",
    "op5_segmented_archives": """
with p as (select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as digest from pages),
o as (select *, min(page_id) over (partition by html) as original, strlen(html) >= 100 as big from p)
select page_id, strlen(html)::bigint as payload_bytes, digest as payload_digest, case when big and original <> page_id then 'revisit' else 'response' end as record_type,
  case when big and original <> page_id then original end as refers_to, null::varchar as problem from o""",
    "op6_chunk_recipes": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))""",
    "op11_positional_index": r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
wins as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as s from (select item_id, w, least(10, len(w)) as k, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as i from b where len(w) > 0)),
laid as (select r, i, k, array_to_string(w[i:i + k - 1], ' ') as s from (select r, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from d cross join (select distinct k from wins) where len(w) >= k)),
occ as (select r, i, k, item_id from laid join wins using (k, s)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + k - 1)) as p from occ) group by r),
ids as (select r, list(item_id order by item_id) as x from (select distinct r, item_id::varchar as item_id from occ) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(x), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(x, ','), '')) as items_sha256, n_hit is not null as contaminated
from d left join hit using (r) left join ids using (r)""",
}
