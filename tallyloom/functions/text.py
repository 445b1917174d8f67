"""Text expressions: sender feature, ASCII filter, tokenizers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns and the separator between summary and review.
MAIL_TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\f\x0B]"
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"
NON_ASCII = r"[^\x00-\x7F]"
SUMMARY_SEPARATOR = "[SOS]"
SEQUENCE_TOKEN = r"\[SOS\]|[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\r\f\x0B]"

SENDER_MODES = ("domain", "full", "none")


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, NON_ASCII, "")


def sender_feature(sender: Column, mode: str = "domain") -> Column:
    """Sender token: mail domain, full address, or nothing."""
    if mode not in SENDER_MODES:
        raise ValueError(f"unknown sender mode {mode!r}, expected one of {SENDER_MODES}")
    if mode == "none":
        return F.lit("")
    tail = sender if mode == "full" else F.substring_index(sender, "@", -1)
    return F.coalesce(ascii_only(F.substring_index(tail, ">", 1)), F.lit(""))


def mail_tokens(body: Column) -> Column:
    """Words and single punctuation marks of the ASCII part, case kept."""
    return F.coalesce(F.regexp_extract_all(ascii_only(body), F.lit(MAIL_TOKEN), F.lit(0)), F.array().cast("array<string>"))


def mail_features(sender: Column, body: Column, mode: str = "domain") -> Column:
    """Sender token, when there is one, followed by the body tokens."""
    feature = sender_feature(sender, mode)
    head = F.when(feature != "", F.array(feature)).otherwise(F.array().cast("array<string>"))
    return F.concat(head, mail_tokens(body))


def word_tokens(text: Column) -> Column:
    """Lower-cased words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_TOKEN), F.lit(0))


def sequence_tokens(text: Column) -> Column:
    """Words, single marks, and the summary separator in one piece."""
    return F.regexp_extract_all(text, F.lit(SEQUENCE_TOKEN), F.lit(0))


def review_text(summary: Column, body: Column, separator: str = SUMMARY_SEPARATOR) -> Column:
    return F.concat(summary, F.lit(separator), body)


def rating(overall: Column) -> Column:
    return overall.cast("double")


def rating_class(overall: Column) -> Column:
    """Class 0..4 of a rating 1..5; missing stays missing."""
    return (overall.cast("double") - 1).cast("int")
