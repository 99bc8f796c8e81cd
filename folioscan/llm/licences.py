"""Licence scan by canonical digests.

A text, and each of its paragraphs and lines, is brought to a canonical form:
lower case, no copyright notices, no punctuation, equivalent spellings unified,
single spaces. The digest of the form is joined to the digests of the known
licences' forms, so only whole texts match, never parts of a sentence. Native
plans only.

There are two forms. One leaves out short paragraphs that begin with a
copyright mark and keeps all other words, so it doesn't depend on where lines
are wrapped. The other leaves out lines that begin with one, for notices that
stand directly above other text. A unit that has either form of a known text
is that licence.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.llm.common import SPARING, small

#: Equivalent spellings, unified word by word.
SPELLINGS = {
    "licence": "license", "licenced": "licensed", "licences": "licenses", "sublicence": "sublicense", "organisation": "organization", "authorised": "authorized",
    "recognise": "recognize", "favour": "favor", "honour": "honor", "whilst": "while", "modelled": "modeled", "labelled": "labeled", "wilful": "willful", "noncommercial": "non commercial",
}
#: Public notices and short licences, by SPDX identifier.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Whole licence texts, named by SPDX identifier (and ~number for another edition), that ship with the package.
TEXTS = Path(__file__).parent / "licence_texts"
#: Titles that stand above short licences, besides none.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"), "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "Unlicense": ("The Unlicense", "Unlicense"),
}
#: Words of a paragraph up to which it is a copyright notice if it begins with a mark of one.
NOTICE = 25
#: What stands between paragraphs of canonical lines.
GAP = r"\n ?\n[ \n]*"
#: Marks of a copyright line that are not words.
HOLDER = ("©", "(c)")


def canonical_lines(text: Column) -> Column:
    """A text in lower case with all signs but line ends as single spaces; copyright signs become the word."""
    return F.regexp_replace(reduce(lambda c, mark: F.replace(c, F.lit(mark), F.lit(" copyright ")), HOLDER, F.lower(text)), r"[^\p{L}\p{N}\n]+", " ")


def joined(lines: Column) -> Column:
    """Canonical lines as one form, without those that begin with a copyright mark."""
    return F.array_join(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("copyright ") & (x != "copyright")), " ")


def unwrapped(text: Column) -> Column:
    """Canonical lines as one form that doesn't depend on their ends, without paragraphs that are copyright notices."""
    parts = F.transform(F.split(text, GAP), lambda p: F.trim(F.regexp_replace(p, "[ \n]+", " ")))
    notice = lambda p: (p.startswith("copyright ") | (p == "copyright")) & (F.size(F.split(p, " ")) <= NOTICE)
    return F.array_join(F.filter(parts, lambda p: (p != "") & ~notice(p)), " ")


def forms_of(text: Column) -> Column:
    """Both forms of canonical lines, one if they are equal."""
    return F.when(text.contains("copyright"), F.array_distinct(F.array(joined(F.split(text, "\n")), unwrapped(text)))).otherwise(F.array(joined(F.split(text, "\n"))))


def spelt(form: Column) -> Column:
    """A form with unified spellings, word by word; only where one of them may apply."""
    marks = reduce(lambda a, b: a | b, (form.contains(k) for k in SPELLINGS))
    unified = F.create_map(*[F.lit(x) for kv in SPELLINGS.items() for x in kv])
    return F.when(marks, F.array_join(F.transform(F.split(form, " "), lambda w: F.coalesce(unified[w], w)), " ")).otherwise(form)


@lru_cache(maxsize=1)
def whole_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of whole licences: as shipped, and the short ones with and without title, numbers and reservation; Apache-2.0 without its appendix too."""
    out = set()
    for path in sorted(TEXTS.glob("*.txt")):
        name, text = path.stem.split("~")[0], path.read_text(encoding="utf-8")
        out.add((name, text))
        if name == "Apache-2.0":
            out.add((name, text.split("APPENDIX: How to apply")[0]))
        if name not in TITLES:
            continue
        titles = {t.lower() for t in TITLES[name]}
        # paragraphs of a notice or a title alone are put together anew
        body = "\n\n".join(p for p in re.split(r"\n\s*\n", text.strip()) if p.strip().lower() not in titles and not (re.match(r"\W*(copyright\b|\(c\)|©)", p.lower()) and len(p.split()) <= NOTICE))
        plain = re.sub(r"(?m)^\s*\(?[0-9]\W\s*", "", body)
        out |= {(name, "\n\n".join(filter(None, (*head, x)))) for x in (body, plain) for head in product(("", *TITLES[name]), ("", "All rights reserved."))}
    return tuple(sorted(out))


def known(spark: SparkSession, licences: DataFrame | None = None) -> DataFrame:
    """digest, licence and length of the known texts' forms; licences: rows of (licence, text) to use in place of KNOWN and whole_texts()."""
    rows = spark.createDataFrame([*KNOWN, *whole_texts()], "licence string, text string") if licences is None else licences.select("licence", "text")
    forms = rows.where("text IS NOT NULL").select("licence", F.explode(forms_of(canonical_lines(F.col("text")))).alias("form"))
    forms = forms.select("licence", spelt(F.col("form")).alias("form")).where("form <> ''")
    # one licence for each form, the first by name
    return forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("licence").alias("licence"), F.max(F.length("form")).alias("n"))


def licence_scan(docs: DataFrame, licences: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each unit of a document that is a known licence text.

    doc_id, unit ("text", "paragraph" or "line"), at (0-based number of the
    unit), licence. Paragraphs are parts between blank lines and lines those
    between line ends; a text without such breaks is only a "text". Null and
    empty texts, and units without letters or digits, match nothing; a null id
    stays null; repeated rows give repeated rows; an empty table an empty one.
    Forms longer than any known one are not digested.
    """
    forms = known(docs.sparkSession, licences)
    longest = forms.agg(F.max("n")).first()[0] or 0
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), canonical_lines(F.col(f"`{text_col}`").cast("string")).alias("c"))
    lines = F.split("c", "\n")

    def unit(kind: str, at: Column, form: Column) -> Column:
        return F.struct(F.lit(kind).alias("unit"), at.cast("long").alias("at"), form.alias("form"))

    none = F.array().cast("array<struct<unit:string,at:bigint,form:string>>")
    each = F.when(F.col("c").contains("\n"), F.transform(lines, lambda x, i: unit("line", i, joined(F.array(x))))).otherwise(none)
    gap = F.col("c").contains("\n\n") | F.col("c").contains("\n \n")
    blocks = F.when(gap, F.flatten(F.transform(F.split("c", GAP), lambda x, i: F.transform(forms_of(x), lambda form: unit("paragraph", i, form))))).otherwise(none)
    whole = F.transform(forms_of(F.col("c")), lambda form: unit("text", F.lit(0), form))
    units = t.select("row", "doc_id", F.explode(F.concat(whole, blocks, each)).alias("u")).select("row", "doc_id", "u.unit", "u.at", "u.form")
    # unified spellings shorten a form by less than a fifth
    units = units.where((F.col("form") != "") & (F.length("form") <= longest * 1.25 + 16))
    digests = units.select("row", "doc_id", "unit", "at", F.sha2(spelt(F.col("form")), 256).alias("digest"))
    found = digests.join(small(forms.select("digest", "licence"), **SPARING), "digest")
    # a unit may match in both forms
    return found.groupBy("row", "doc_id", "unit", "at").agg(F.min("licence").alias("licence")).select("doc_id", "unit", "at", "licence")
