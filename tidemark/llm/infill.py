"""Fill-in-the-middle examples: a text is cut at two of its units, and its middle is moved to the end.

``regexp_count`` gives the number of units. From it and two hashes of the document's id come two cuts a <= b, and from these
a pattern of the row's own: a group of ``unit{a}+``, one of ``unit{b-a}+`` and one of the rest. A single match captures prefix,
middle and suffix, and the replacement's template puts them in their new order. Possessive counts never give back what they
took, so a match runs once over the text without recursion, however many units it has.

A null or empty text and a text that holds a mark already stay as they are (``plain``). So marks in an output are only those
that were put there, and ``restored`` rebuilds the text from the output and its form alone. Texts are taken whole, however
long; a row's cost is linear in its text, and no row meets another: nothing is shuffled. A null doc_id draws as an empty one;
repeated ids draw the same cuts, each on its own text. Empty tables give empty results; other columns than doc_id and text are
left behind, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or the last one without. A unit must not match an empty string.
LINE = r"[^\n]*\n|[^\n]+"
#: What stands before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")

#: form -> the order of its parts; 0 is the prefix, 1 the suffix, 2 the middle.
ORDER = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
#: part -> the group that captures it in a text.
GROUP = (1, 3, 2)


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _chosen(form: Column, values: dict[str, Column]) -> Column:
    """The value of the row's form; null if it is plain."""
    return F.coalesce(*[F.when(form == name, value) for name, value in values.items()])


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of a form was made of."""

    def undone(order: tuple[int, ...]) -> Column:
        at = {part: i + 1 for i, part in enumerate(order)}
        pattern = "".join(f"{re.escape(marks[part])}(.*)" for part in order)
        return F.regexp_replace(output, F.lit(rf"(?s)\A{pattern}\z"), F.lit(f"${at[0]}${at[2]}${at[1]}"))

    return F.coalesce(_chosen(form, {name: undone(order) for name, order in ORDER.items()}), output)


def infill(
    docs: DataFrame, unit: str = LINE, marks: tuple[str, str, str] = MARKS, seed: int = 7, percent: int = 100, spm: int = 50
) -> DataFrame:
    """A row per document: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output.

    ``percent`` of the texts that can be cut are, and ``spm`` percent of these begin with the suffix. Texts must not tell marks
    apart by their surroundings: a mark begins with a character that it holds only once.
    """
    if any(not m or m[0] in m[1:] for m in marks) or len({*marks}) < 3:
        raise ValueError("marks must differ and hold their first character once")
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)
    held = F.lit(False)
    for mark in marks:
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | held | (h3 % 100 >= percent)
    form = F.when(plain, F.lit("plain")).when(h4 % 100 < spm, F.lit("spm")).otherwise(F.lit("psm"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(unit)).cast("bigint").alias("n"), form.alias("form"))

    cuts = [h % (F.col("n") + 1) for h in (h1, h2)]
    rows = rows.withColumns({"first": F.least(*cuts), "last": F.greatest(*cuts)})
    times = [F.col("first").cast("string"), (F.col("last") - F.col("first")).cast("string")]
    counted = [part for k in times for part in (F.lit(f"((?:{unit}){{"), k, F.lit("}+)"))]
    pattern = F.concat(F.lit(r"(?s)\A"), *counted, F.lit(r"(.*)\z"))
    made = {
        name: F.regexp_replace("text", pattern, F.lit("".join(f"{_literal(marks[part])}${GROUP[part]}" for part in order)))
        for name, order in ORDER.items()
    }
    rows = rows.withColumn("output", F.coalesce(_chosen(F.col("form"), made), F.col("text")))

    # No part of a text can be read as a mark, so the marks' places give the parts' lengths.
    prefix_at, suffix_at, middle_at = [F.instr("output", F.lit(m)) for m in marks]
    after = {"psm": suffix_at, "spm": middle_at}
    prefix = _chosen(F.col("form"), {name: end - prefix_at - len(marks[0]) for name, end in after.items()})
    middle = F.when(F.col("form") != "plain", F.length("output") - middle_at - len(marks[2]) + 1)
    return rows.select(
        "doc_id", "n", "form", prefix.cast("bigint").alias("prefix_chars"), middle.cast("bigint").alias("middle_chars"), "output"
    )


def _literal(mark: str) -> str:
    """A mark as it is written in a replacement."""
    return re.sub(r"([\\$])", r"\\\1", mark)
