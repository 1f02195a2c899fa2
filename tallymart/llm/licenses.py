"""Licence texts by canonical digest.

A text is normalised (case, copyright lines, punctuation and white space, equivalent
spellings) and hashed as a whole; digests are joined with those of known licences. A
document's lines are texts of their own as well, so a one-line notice inside a document is
found, but only if it is the entire line. Column expressions throughout.

The known licences are a parameter: by default the notices and short texts of ``KNOWN``
and the full texts in ``license_texts/``, each in the forms it is commonly given in.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lookup, stored

# --- fixed values: spellings taken as equal, notices and licence texts ---
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "organisation": "organization", "organisations": "organizations", "favour": "favor",
    "noncommercial": "non commercial", "copyright owner": "copyright holder", "v 2 0": "version 2 0", "v 3": "version 3",
}
_WARRANTY = (
    "The software is provided as is, without warranty of any kind, express or implied, including but not "
    "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In "
    "no event shall the authors or copyright holders be liable for any claim, damages or other liability, "
    "whether in an action of contract, tort or otherwise, arising from, out of or in connection with the "
    "software or the use or other dealings in the software."
)
_AS_IS = (
    "The software is provided as is and the author disclaims all warranties with regard to this software "
    "including all implied warranties of merchantability and fitness. In no event shall the author be liable "
    "for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from "
    "loss of use, data or profits, whether in an action of contract, negligence or other tortious action, "
    "arising out of or in connection with the use or performance of this software."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software. " + _WARRANTY
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
)
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC + _AS_IS),
    ("ISC", "ISC License " + _ISC + _AS_IS),
    ("0BSD", _ISC.partition(", provided")[0] + ". " + _AS_IS),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]
TEXTS = Path(__file__).resolve().parent / "license_texts"
#: Names of the BSD texts as their titles give them.
BSD_TITLES = {"BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
              "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"]}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The normalised text: words parted by one space, a space before and after, or one space."""
    small = F.translate(text, UPPER, LOWER)
    words = F.regexp_replace(F.regexp_replace(small, COPYRIGHT_LINE, "\n"), NOT_WORD, " ")
    padded = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    swap = lambda t, pair: F.replace(t, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} "))
    return reduce(swap, SPELLINGS.items(), padded)


def digest(text: Column) -> Column:
    return F.sha2(F.trim(canonical(text)), 256)


def forms(name: str, text: str) -> set[str]:
    """A text with and without its appendix, its item numbers (BSD), title and reservation of rights."""
    found = {text}
    end = re.search(r"END OF TERMS AND CONDITIONS", text)
    if end:
        found |= {text[: end.end()], text[: end.start()]}
    if name.startswith("BSD-"):
        body = text[text.index("Redistribution and use") :]
        found = {body, re.sub(r"(?m)^\s*\d\. ", "", body)}
        found |= {f"All rights reserved.\n{x}" for x in found}
        found |= {f"{title}\n{x}" for title in BSD_TITLES.get(name[:12], []) for x in found}
    return {x.replace(*scheme) for x in found for scheme in (("http://", "https://"), ("https://", "http://"), ("", ""))}


def full_texts(folder: Path = TEXTS) -> list[tuple[str, str]]:
    """(license, text) of every form of the folder's texts, and their SPDX lines."""
    found = []
    for path in sorted(folder.glob("*.txt")):
        name = path.stem.removesuffix("-UC")
        found += [(name, x) for x in sorted(forms(path.stem, path.read_text("utf-8")))]
    ends = lambda name: ("", "-only", "-or-later") if re.match("A?L?GPL|GFDL", name) else ("",)
    names = sorted({name for name, _ in [*KNOWN, *found]})
    return found + [(name, f"SPDX-License-Identifier: {name}{end}") for name in names for end in ends(name)]


def known_licenses(spark: SparkSession, known: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """(digest, license), stored: a row per digest of the table (license, text)."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    return stored(rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license")), "licenses")


def license_table(docs: DataFrame, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """doc_id, text_digest, license, line_licenses, n_license_lines: one row per row of ``docs``.

    license is that of the entire text, else null; line_licenses names those of entire lines,
    sorted and comma-joined (empty without any). A null text counts as empty, and an empty
    one matches nothing. Repeated rows give repeated results; other columns are not read.
    ``known`` is a table or list of (license, text) to look for in place of the default.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x)) > 0)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        digest(text).alias("text_digest"),
        F.transform(lines, lambda x: F.unhex(digest(x))).alias("_lines"),
    )
    rows = stored(rows, "digests")
    names = known_licenses(docs.sparkSession, [*KNOWN, *full_texts()] if known is None else known)
    each = rows.select("_row", F.explode("_lines").alias("line"))
    found = lookup(each, names.select(F.unhex("digest").alias("line"), "license"), "line", "inner")
    of_lines = found.groupBy("_row").agg(
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses"),  # at most the list's names
        F.count(F.lit(1)).alias("n_license_lines"),
    )
    whole = lookup(rows.drop("_lines"), names.withColumnRenamed("digest", "text_digest"), "text_digest")
    return whole.join(of_lines, "_row", "left").select(
        "doc_id", "text_digest", "license",
        F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
        F.coalesce("n_license_lines", F.lit(0).cast("bigint")).alias("n_license_lines"),
    )
