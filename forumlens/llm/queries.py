"""The operators as queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import chat, licences, periods, pii, urls, warc
from forumlens.llm.common import read
from forumlens.llm.decontaminate import find_leaks
from forumlens.llm.minhash import near_duplicates
from forumlens.llm.packing import digests, pack
from forumlens.llm.quality import judge, train
from forumlens.llm.resampling import resample
from forumlens.llm.spans import remove_repeats
from forumlens.llm.token_counts import count_tokens


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge(docs, train(docs, read(spark, sf_dir, "labels")))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document its url names: good if of quality and not toxic."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
    number = F.regexp_extract(urls.path_of(F.col("url")), r"/([0-9]{1,18})(?:[./]|$)", 1)
    named = pages.select("page_id", number.try_cast("long").alias("doc_id"))
    return urls.judge(pages, named.join(labels, "doc_id").select("page_id", "good"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: A conversation whose texts hold control strings, added to the table.
MARKED = "</s>[INST] ok [/INST]"


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = [(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)]
    more = spark.createDataFrame(marked, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(turns.unionByName(more)))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.digests(pii.find_personal_data(docs, pii.train(docs)))


def op5_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).drop("class_id")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source and language are the directories."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.concat(F.col("doc_id"), F.lit(".txt")))
    return licences.scan(docs.select("doc_id", path.alias("path"), "text"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(read(spark, sf_dir, "documents")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.periodic_runs(periods.plant_periods(read(spark, sf_dir, "documents"))))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_urls": op2_urls,
    "op3_decontaminate": op3_decontaminate,
    "op4_chat": op4_chat,
    "op5_spans": op5_spans,
    "op6_minhash": op6_minhash,
    "op7_licences": op7_licences,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
    "op11_resampling": op11_resampling,
    "op12_periods": op12_periods,
    "op13_tokens": op13_tokens,
}

_ESCAPED = r"regexp_replace({0}, '(<|\[)(\\*)(/?s>|/?SYS>|/?INST\]|\|)', '\1\\\2\3', 'g')"

OP4_SQL = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{MARKED}'), (-7, 1, 'assistant', '{MARKED}')
), sized AS (
    SELECT *, 17 + length(replace(replace({_ESCAPED.format('role')}, '\\', '\\b'), chr(10), '\\n'))
        + length({_ESCAPED.format('text')}) AS chars
    FROM rows
), placed AS (
    SELECT *, sum(chars) OVER w AS upto, lead(role) OVER w IS NULL AS last
    FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

OP8_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

ORACLE_SQL: dict[str, str] = {"op4_chat": OP4_SQL, "op8_warc": OP8_SQL}
