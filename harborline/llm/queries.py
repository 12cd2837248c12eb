"""Queries of the operators on training text, with their SQL where SQL can state them."""

from __future__ import annotations

from harborline.llm import contamination, mixture, personal_data, reading_level
from harborline.session import table


def p2_found(spark, sf):
    """Each item of personal data in the free texts."""
    found = personal_data.items(table(spark, sf, "delivery_records"))
    return found.select("record_id", "field_name", "pii_type", found.item_no.cast("int").alias("item_no"))


def p2_masked(spark, sf):
    """The texts with typed placeholders."""
    return personal_data.masked(table(spark, sf, "delivery_records"))


def p8_found(spark, sf):
    """Documents that repeat at least twelve words of an evaluation item, with the item."""
    return contamination.leaked(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_passages(spark, sf):
    """The passages to remove."""
    return contamination.passages(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_removal(spark, sf):
    """What to cut out of each document."""
    return contamination.removal_spans(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p9_mixture(spark, sf):
    """The mixture, shuffled."""
    return mixture.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p9_shares(spark, sf):
    """Target and reached shares."""
    return mixture.shares(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def _ranker(spark, sf):
    return reading_level.fitted(table(spark, sf, "documents"), table(spark, sf, "reading_labels"))


def p10_found(spark, sf):
    """The reading band of each document of English prose."""
    return reading_level.levels(table(spark, sf, "documents"), _ranker(spark, sf)).select("doc_id", "reading_band")


def p10_profile(spark, sf):
    """How demanding each source is."""
    return reading_level.profile(table(spark, sf, "documents"), _ranker(spark, sf))


QUERIES = {"p2_found": p2_found, "p2_masked": p2_masked, "p8_found": p8_found, "p8_passages": p8_passages, "p8_removal": p8_removal, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_profile": p10_profile}

def _words_sql(source: str, key: str) -> str:
    """Words of the texts of a table as lists: full-width letters and digits as plain ones, without markup, accents and signs inside words."""
    wide, narrow = ("".join(chr(c + k) for a, b in (("0", "9"), ("A", "Z"), ("a", "z")) for c in range(ord(a), ord(b) + 1)) for k in (0xFEE0, 0))
    text = f"translate(replace(regexp_replace(text, '</?[A-Za-z][^<>]*>', ' ', 'g'), 'ﬁ', 'fi'), '{wide}', '{narrow}')"
    text = f"regexp_replace(text_, '[''’‘\\x{{200b}}\\x{{ad}}]', '', 'g')".replace("text_", f"lower(strip_accents({text}))")
    return f"SELECT DISTINCT {key}, list_filter(regexp_split_to_array({text}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM {source} WHERE {key} IS NOT NULL AND text IS NOT NULL"


def _runs_sql(source: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[k:k + {contamination.LEAST_WORDS - 1}], ' ') AS run FROM (SELECT {key}, w, unnest(range(1, len(w) - {contamination.LEAST_WORDS - 2})) AS k FROM ({_words_sql(source, key)}))"


ORACLE: dict[str, str] = {
    "p8_found": f"SELECT DISTINCT doc_id, item_id FROM ({_runs_sql('documents', 'doc_id')}) JOIN ({_runs_sql('eval_items', 'item_id')}) USING (run)",
}
