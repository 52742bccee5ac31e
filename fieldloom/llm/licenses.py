"""License scans: canonical texts looked up by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts and notices of known licences.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
]

#: Titles under which the body of a licence is handed out.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "Zlib": ("zlib License", "The zlib/libpng License"),
    "Unlicense": ("The Unlicense",),
}

#: Digests of the canonical whole texts, as their authors publish them, of licences too long to be written here.
DIGESTS = [
    ("Apache-2.0", "6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "58b6ebdf2bd26f81dd551d8efda909bfbc8914ce77996a5c289c28616b91ceeb"),
    ("GFDL-1.3", "c4f8ea2b5247ab1ff721ce8255137250d4c14f50a0fb68c00fd793f496ced65e"),
    ("GPL-1.0", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-2.0", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-3.0", "3c39b58d51baf32b2a21a55c429305f51cfd82e53cad05134293933580b4cd84"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
]

#: Spellings taken for the same (both engines' patterns; applied in this order to lower-case text).
SAME = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("noncommercial", "non-commercial"),
    ("https:", "http:"),
]
#: A line that is a copyright notice and no more, and what is not a letter or digit.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*((copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*|copyright[ \t]*(\(c\)|©)[^\n]*|©[^\n]*|all rights reserved[. \t]*(\n|$))"
PUNCTUATION = r"[\x00-\x1f !-/:-@\[-`{-~©®™“”‘’«»–—]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Lower case (A-Z), without copyright lines, one spelling for each word, and one blank between words."""
    out = F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT_LINE, "$1")
    for a, b in SAME:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def digest(text: Column) -> Column:
    """sha256 of the canonical text."""
    return F.sha2(canonical(text), 256)


def _texts() -> list[tuple[str, str]]:
    long = [(i, t) for i, t in KNOWN if len(t) > 300]  # a body, not a notice
    return KNOWN + [(i, f"{title}\n\n{t}") for i, t in long for title in TITLES.get(i, ())]


def catalog(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """license_id and digest of each known text; repeated digests keep the first id in order of name.

    Without known: the texts of KNOWN, those of TITLES with each title before them, and the digests of DIGESTS."""
    rows = spark.createDataFrame(_texts() if known is None else known, "license_id string, text string").select("license_id", digest(F.col("text")).alias("digest"))
    if known is None:
        rows = rows.union(spark.createDataFrame(DIGESTS, "license_id string, digest string"))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"))


#: Digests up to which the catalogue is broadcast; a larger one is joined by shuffling.
BROADCAST_ROWS = 200_000


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, license_id, line_licenses and n_license_lines of every row of docs.

    license_id: the licence whose text the whole document is, canonically (null: none).  line_licenses: the
    licences, in order and joined by commas, whose text one of its lines is (empty: none); n_license_lines:
    how many lines are.  A null or blank text has the digest of the empty text and no licence.  Rows that
    repeat a doc_id are judged each for itself, a null doc_id too.  Empty docs: an empty result.

    The catalogue is broadcast where it is small (checked) and joined by shuffling digests beyond.  Only the lines
    that are found, and digests, are shuffled; no text is.
    """
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    whole = rows.select("doc_id", "tag", digest(F.col("text")).alias("digest")).join(known, "digest", "left")
    lines = rows.select("doc_id", "tag", F.posexplode(F.split("text", "\n")).alias("number", "line")).filter("line != ''")
    found = lines.select("doc_id", "tag", "number", digest(F.col("line")).alias("digest")).join(known, "digest")
    hits = found.groupBy("doc_id", "tag").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses"), F.count_distinct("number").alias("n"))
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("tag").alias("hit_tag"), "line_licenses", "n")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("tag") == F.col("hit_tag"))
    return whole.join(hits, same, "left").select("doc_id", "digest", "license_id", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"), F.coalesce("n", F.lit(0)).alias("n_license_lines"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), {_quoted(COPYRIGHT_LINE)}, '\\1', 'g')"
    for a, b in SAME:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return f"trim(regexp_replace({out}, {_quoted(PUNCTUATION)}, ' ', 'g'))"


SCAN_SQL = f"""
with known(license_id, text) as (values {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in _texts())}),
ids as (select digest, min(license_id) as license_id from (select sha256({_canonical_sql("text")}) as digest, license_id from known union all (values {", ".join(f"({_quoted(b)}, {_quoted(a)})" for a, b in DIGESTS)})) group by 1),
docs as (select doc_id, text, sha256({_canonical_sql("coalesce(text, '')")}) as digest from documents),
lines as (select doc_id, sha256({_canonical_sql("line")}) as digest
          from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents)),
hits as (select doc_id, string_agg(distinct license_id, ',' order by license_id) as line_licenses, count(*) as n
         from lines join ids using (digest) group by doc_id)
select docs.doc_id, docs.digest, ids.license_id, coalesce(line_licenses, '') as line_licenses, coalesce(n, 0) as n_license_lines
from docs left join ids using (digest) left join hits using (doc_id)
"""
