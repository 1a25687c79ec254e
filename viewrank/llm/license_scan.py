"""Licence scan: texts and their lines compared with licence templates by Dice over word bigrams.

Normalised text is lower case, with every run of other characters than letters and digits as one
blank. Its bigrams are compared as sets: twice the common ones over the sum of both sizes. Two sets
can only reach a similarity s if the smaller holds s / (2 - s) of the larger, so most templates (and
for nearly all lines, all of them) are ruled out by the number of words before any bigram is built.

A unit is the whole text or one of its lines. All is DataFrame functions on the row itself: no
shuffle. A unit takes the most similar template at or above the limit, ties to the first name. Null
and empty texts have no units that match.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SIMILARITY = 0.8

# Wording of public licences and of the usual notices of them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions and limitations under "
    "the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS "
    "IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
    "General Public License for more details. You should have received a copy of the GNU General Public License along "
    "with this program. If not, see https://www.gnu.org/licenses/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
    "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Released under the MIT License.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
    "above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.",
}


def bigrams(text: str) -> set[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def _literal(templates: dict[str, str], similarity: float) -> str:
    """The templates as SQL: name, number of bigrams, the sizes that can match, and the bigrams."""
    rows = []
    for name in sorted(templates):
        own = bigrams(templates[name])
        if not own:
            raise ValueError(f"template {name} has no two words")
        reach = similarity / (2 - similarity)
        quoted = ", ".join(f"'{b}'" for b in sorted(own))
        plain = name.replace("'", "")
        rows.append(
            f"named_struct('name', '{plain}', 'size', {len(own)}, 'low', {len(own) * reach!r}D, "
            f"'high', {len(own) / reach!r}D, 'own', array({quoted}))"
        )
    return f"array({', '.join(rows)})"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, similarity: float = MIN_SIMILARITY) -> DataFrame:
    """`doc_id, unit, license, dice`: one row per match. Unit 0 is the whole text, n its n-th line.

    A text of one line is matched as a whole only.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity must lie in (0, 1]")
    table = _literal(templates or TEMPLATES, similarity)
    lengths = [len(bigrams(t)) for t in (templates or TEMPLATES).values()]
    reach = similarity / (2 - similarity)
    low = min(lengths) * reach
    units = docs.select(
        "doc_id",
        F.posexplode(
            F.expr(r"if(instr(text, '\n') = 0, array(text), concat(array(text), split(text, r'\n')))")
        ).alias("unit", "body"),
    )
    # The array around an expression names it for what follows, so that it is computed once.
    compared = units.filter(F.length("body") >= 2 * low).select(
        "doc_id",
        "unit",
        F.expr(
            f"""
            transform(array(split(trim(regexp_replace(lower(body), '[^a-z0-9]+', ' ')), ' ')), w -> if(size(w) - 1 < {low!r}D, null,
              transform(array(array_distinct(transform(sequence(0, size(w) - 2), i -> concat(w[i], ' ', w[i + 1])))), b ->
                aggregate(
                  filter({table}, t -> size(b) >= t.low and size(b) <= t.high),
                  named_struct('dice', 0.0D, 'name', cast(null as string)),
                  (best, t) -> transform(array(2.0D * size(array_intersect(b, t.own)) / (size(b) + t.size)), d ->
                    if(d > best.dice, named_struct('dice', d, 'name', t.name), best))[0]))[0]))[0]
            """
        ).alias("best"),
    )
    return compared.filter(F.col("best.dice") >= similarity).select(
        "doc_id", "unit", F.col("best.name").alias("license"), F.col("best.dice").alias("dice")
    )
