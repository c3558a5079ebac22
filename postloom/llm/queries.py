"""Queries of the text operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postloom.llm.entities import entity_pairs, link_senders
from postloom.llm.lookalike import lookalike_pairs, normalise_texts
from postloom.llm.mixing import mix_sources
from postloom.llm.own_text import foreign_lines, own_texts
from postloom.llm.personal import find_items, replace_items
from postloom.llm.tokenizer import count_tokens, decode_ids, encode_texts, encode_with_places
from postloom.runtime import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_items(table(spark, folder, "emails"))


def p1_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Each body with its personal items replaced by placeholders."""
    return replace_items(table(spark, folder, "emails"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return foreign_lines(table(spark, folder, "emails")).select("pos", "line_no")


def p2_own_text(spark: SparkSession, folder: str) -> DataFrame:
    """Each mail reduced to its sender's words."""
    return own_texts(table(spark, folder, "emails"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return entity_pairs(table(spark, folder, "senders"))


def p5_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The entity of each sender row."""
    return link_senders(table(spark, folder, "senders"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents"))


def p8_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of each document."""
    return count_tokens(table(spark, folder, "documents"))


def p8_places(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of each document with the places of their slices in its text."""
    return encode_with_places(table(spark, folder, "documents"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Each document encoded and decoded again; the SQL takes the texts as they are."""
    return decode_ids(encode_texts(table(spark, folder, "documents")))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the mix and how often each is used."""
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of each source."""
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike_pairs(table(spark, folder, "documents"))


def p10_forms(spark: SparkSession, folder: str) -> DataFrame:
    """The one form of each document's text."""
    return normalise_texts(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p2_found, p2_own_text, p5_found, p5_entities, p8_ids, p8_counts, p8_places, p8_decoded, p9_mix, p9_report, p10_found, p10_forms)}
SQL = {"p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
