"""License scans: canonical digests of whole texts and lines, looked up among known licences."""

from __future__ import annotations

import re
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltscape.functions.staging import stage
from voltscape.llm.common import attach

# ------------------------------------------------------------------ fixed values
#: Notices that stand for a licence, by SPDX identifier. Public wording.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    # what the licences say to put at the head of a file
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\n"
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.\nYou should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
    ),
)
#: Whole licences that are short, one line per paragraph; the long ones lie in `license_texts`.
SHORT_TEXTS = (
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
)
#: Headings that stand before a text that has none of its own.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: Paragraphs that are the heading of a text that has one: one, unless stated here.
HEADINGS = {"CC0-1.0": 2, "MPL-1.1": 2}
#: Where instructions for users of the licence begin, which many copies leave out.
APPENDIX = r"(?m)^\s*(APPENDIX: How to apply|Appendix: How to Apply|How to Apply These Terms|ADDENDUM: How to use)"
END = r"END OF TERMS AND CONDITIONS\s*\Z"
#: Wording that differs between issues of one text.
ISSUES = (
    (r"https://", "http://"),
    (r"51\s+Franklin\s+St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301", "59 Temple Place, Suite 330, Boston, MA 02111-1307"),
    (r"http://(?=www\.apache\.org|unlicense\.org)", "https://"),
)
#: Spellings that count as equal, as whole words.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("noninfringement", "non infringement"),
    ("percent", "per cent"),
    ("copyright owner", "copyright holder"),
)
# -------------------------------------------------------------------------------


def _forms(name: str, text: str) -> list[str]:
    """The ways in which a text is commonly given: with and without its heading, its appendix and
    the words that end it, with the copyright line of the appendix filled in, and as other issues."""
    found = [text]
    if name in TITLES:
        if name.startswith("BSD"):
            # a copyright line without a year is part of the canonical form
            found += [re.sub(r"\ACopyright.*\n(All rights reserved\.\n)?\s*", "", text)]
            # some copies have bullets for numbers
            found += [re.sub(r"(?m)^[ \t]*[0-9]\.[ \t]", " ", t) for t in found]
        if name != "Unlicense":
            found += [f"All rights reserved.\n\n{t}" for t in found]
        found += [f"{title}\n\n{t}" for title in TITLES[name] for t in found]
    else:
        found += ["\n\n".join(re.split(r"\n\s*\n", text.strip("\n\f "))[HEADINGS.get(name, 1) :])]
        found += [re.sub(r"(?m)^[ \t]*Copyright \[yyyy\].*$", "", t) for t in found]
        short = [t[: m.start()] for t in found if (m := re.search(APPENDIX, t))]
        found += short + [re.sub(END, "", t) for t in short]
    for old, new in ISSUES:
        found += [re.sub(old, new, t) for t in found]
    return list(dict.fromkeys(found))


def _long_texts() -> list[tuple[str, str]]:
    paths = sorted((files("voltscape.llm") / "license_texts").iterdir(), key=lambda p: p.name)
    # several wordings of one licence are told apart by what follows @
    return [(p.name.removesuffix(".txt").split("@")[0], p.read_text("utf-8")) for p in paths if p.name.endswith(".txt")]


#: Every form of every whole licence.
TEXTS = tuple((name, form) for name, text in (*_long_texts(), *SHORT_TEXTS) for form in reversed(_forms(name, text)))


#: A line that states a copyright: a mark and a year on it, or the word with a mark, a place for the year,
#: or "by" behind it.
COPYRIGHT_LINE = (
    r"(?mid)^[ \t]*((copyright|\(c\)|©)[^\n]*[0-9]{4}|copyright[ \t:]+(\(c\)|©|<|\[yyyy\]|\{yyyy\}|by[ \t]))[^\n]*$"
)
NO_WORD = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def canonical(text: str) -> str:
    """SQL for the canonical form: lines that only state a copyright go, A-Z are lower-cased, all
    but letters, digits and longer characters become single spaces, spellings are unified."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = f"translate(regexp_replace({text}, r'{COPYRIGHT_LINE}', ' '), '{upper}', '{lower}')"
    # words stand between two spaces each, so that neighbours don't share one
    found = f"concat(' ', regexp_replace({plain}, r'{NO_WORD}', '  '), ' ')"
    for old, new in SPELLINGS:
        old, new = old.replace(" ", "  "), new.replace(" ", "  ")
        found = f"replace({found}, ' {old} ', ' {new} ')"
    return f"trim(replace({found}, '  ', ' '))"


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, text) of the licences and notices above. The list is fixed: one partition of
    it, from Arrow, needs no Python worker and is staged as one file."""
    names, texts = zip(*TEXTS, *NOTICES)
    return spark.createDataFrame(pa.table({"license_id": names, "text": texts})).coalesce(1)


def license_digests(licenses: DataFrame) -> DataFrame:
    """(digest, license_id): one row per canonical text; of several identifiers the first."""
    digest = licenses.where("text is not null").selectExpr(f"sha2({canonical('text')}, 256) as digest", "license_id")
    return digest.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """(doc_id, digest, license_id, line_licenses, n_license_lines) for every row of `docs`.

    digest is the SHA-256 of the whole text in canonical form, license_id the known licence with
    the same digest, or NULL. A document that only cites a licence is found by its lines: each is
    put into canonical form and looked up whole in the same way; line_licenses lists the
    identifiers in order, without repeats, joined by commas ('' for none). Nothing but equal
    canonical texts match. Lines are looked up where they stand: the digests of all known licences
    are joined by hash, and broadcast if their counted number is small, so no text is shuffled
    then. NULL and empty texts have the digest of the empty text and no licence; repeated rows
    come out repeated; an empty table gives an empty result; other columns are ignored.
    """
    known = stage(license_digests(licenses), "licenses")
    rows = docs.selectExpr("doc_id", "coalesce(text, '') as text")
    rows = rows.selectExpr("doc_id", "xxhash64(text) as _hash", "text")
    lines = rows.selectExpr("doc_id", "_hash", "posexplode(split(text, '\\n', -1)) as (_line, _text)")
    cited = attach(lines.selectExpr("doc_id", "_hash", "_line", f"sha2({canonical('_text')}, 256) as digest"), known, ["digest"])
    # a repeated row has the same lines again
    per_text = cited.groupBy("doc_id", "_hash").agg(
        F.expr("array_join(array_sort(collect_set(license_id)), ',')").alias("line_licenses"),
        F.countDistinct("_line").alias("n_license_lines"),
    )
    per_text = per_text.withColumnsRenamed({"doc_id": "_id", "_hash": "_same"})
    whole = rows.selectExpr("doc_id", "_hash", f"sha2({canonical('text')}, 256) as digest")
    found = attach(whole, known, ["digest"], "left").join(per_text, F.expr("doc_id <=> _id and _hash = _same"), "left")
    return found.selectExpr(
        "doc_id", "digest", "license_id", "coalesce(line_licenses, '') as line_licenses", "coalesce(n_license_lines, 0L) as n_license_lines"
    )
