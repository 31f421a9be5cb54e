"""License scans: texts put into a canonical form, digested, and joined with known digests.

The canonical form leaves out what license matching guidelines leave out: case,
punctuation, white space, copyright lines and differences of spelling. A text is a known
license if its whole canonical form is. The same is asked of every line of a longer text,
which finds notices that name a license in a line of their own.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, texts
from scholaris.sources.workspace import stored

# Spellings that license matching guidelines hold equivalent, each with the
# one it is written as.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# Whole license texts and the one-line notices of licenses, by SPDX name.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
_BSD_2 = next(text for name, text in KNOWN if name == "BSD-2-Clause").split("\n")
_CLAUSE_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission."
)
KNOWN += (("BSD-3-Clause", "\n".join([*_BSD_2[:-1], _CLAUSE_3, _BSD_2[-1]])),)

# The title lines that whole texts are given with; each makes one more known text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License"),
}
KNOWN += tuple((name, f"{title}\n{text}") for name, text in KNOWN if "\n" in text for title in TITLES.get(name, ()))

_SPELLINGS = {a.encode(): b.encode() for a, b in EQUIVALENT.items()}
# A copyright line: after comment signs or list marks, one of these words or signs. Where a
# sentence of a license is broken before "copyright holders" and the like, it is none.
_COPYRIGHT = re.compile(rb"[ \t*#/;|%<>=!-]*(?:copyright\b(?![ \t]+(?:holders?|owners?|notices?|laws?|licenses?|statements?|and|or|in|to|interests?)\b)|\(c\)|\xc2\xa9|all rights reserved\b)")
# Typographic dashes and quotes, the no-break space, the copyright sign and angle quotes.
_QUOTES = re.compile(rb"\xe2\x80[\x90-\x9f]|\xc2[\xa0\xa9\xab\xbb]")
_KEPT = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def canonical_lines(text: bytes) -> list[bytes]:
    """The words of every line that has some, in small letters, without copyright lines, equally spelled.

    Letters beyond ASCII stay as they are.
    """
    found = []
    for line in text.lower().split(b"\n"):
        if not _COPYRIGHT.match(line):
            words = _QUOTES.sub(b" ", line).translate(_KEPT).split()
            if words:
                found.append(b" ".join([_SPELLINGS.get(word, word) for word in words]))
    return found


def digests(table: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, raw, digest, lines): digests of a row's text, its canonical form and its distinct canonical lines."""
    rows = table.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            raws, wholes, lines = [], [], []
            for text in texts(batch.column(1)):
                canonical = canonical_lines(text)
                raws.append(hashlib.sha256(text).digest())
                wholes.append(hashlib.sha256(b" ".join(canonical)).hexdigest())
                lines.append([hashlib.sha256(line).hexdigest() for line in set(canonical)] if len(canonical) > 1 else [])
            columns = [batch.column(0), pa.array(raws, pa.binary()), pa.array(wholes, pa.string()), pa.array(lines, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "raw", "digest", "lines"])

    return map_batches(rows, work, f"id {kind}, raw binary, digest string, lines array<string>")


def scanned(
    docs: DataFrame,
    known: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    known_digests: tuple[tuple[str, str], ...] = (),
) -> DataFrame:
    """(id, digest, license, notices array<string>) of every row.

    `known` has license and text, any number of rows; `known_digests` adds pairs of a license
    and the digest of a canonical form. `digest` is the SHA-256 of the whole
    text's canonical form, `license` the known license of that digest (the first by name, if
    several share one) or null. `notices` names the licenses that lines of a longer text are,
    sorted, each once; it is empty without any, and for texts of one line, which are whole.
    Null, empty and other texts without words have the digest of an empty form and no
    license; known texts without words are left out. Repeated rows and null ids stay, an
    empty table gives no rows.

    Texts meet known ones by equal digests only. Notices depend on the text alone, so they
    are joined back by its digest, and copies of a text are one row there.
    """
    rows = stored(digests(docs, id_column, text_column), "digests")
    empty = hashlib.sha256(b"").hexdigest()
    named = digests(known, "license", "text").where(F.col("digest") != empty).select("id", "digest")
    if known_digests:
        named = named.union(docs.sparkSession.createDataFrame(list(known_digests), "id string, digest string"))
    named = stored(named.groupBy("digest").agg(F.min("id").alias("license")), "licenses")
    lines = rows.select("raw", F.explode("lines").alias("digest")).join(named, "digest")
    notices = lines.groupBy("raw").agg(F.sort_array(F.collect_set("license")).alias("notices"))
    found = rows.drop("lines").join(named, "digest", "left").join(notices, "raw", "left")
    none = F.array().cast("array<string>")
    return found.select(F.col("id").alias(id_column), "digest", "license", F.coalesce("notices", none).alias("notices"))
