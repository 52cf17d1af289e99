"""Licence scan by canonical digests.

Texts are brought into a canonical form that follows the public matching
guidelines for licence texts: case, punctuation and white space do not count,
copyright lines are left out, equivalent spellings become one.  The digest of
an entire text (a whole document, and each of its lines) is then hash-joined
to the digests of known licence texts and notices, brought into the same form.

Matches are few and are gathered per document after the join; the known
digests are broadcast only while ``KNOWN_MAX`` rows bound them.

Cases: NULL and empty texts hold no licence, and neither does a text of
copyright lines alone; rows that repeat get one output row each with equal
findings; other columns pass through, one named like an output column is
replaced; an empty table or an empty list of licences gives no findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known digests up to this number are broadcast (32 bytes each and a name).
KNOWN_MAX = 100_000

#: Spellings that count as equal, first form canonical.
EQUIVALENT = [
    ("license", ["licence"]),
    ("licensed", ["licenced"]),
    ("sublicense", ["sublicence", "sub license", "sub licence"]),
    ("acknowledgment", ["acknowledgement"]),
    ("analog", ["analogue"]),
    ("analyze", ["analyse"]),
    ("artifact", ["artefact"]),
    ("authorization", ["authorisation"]),
    ("authorized", ["authorised"]),
    ("copyright holder", ["copyright owner"]),
    ("favor", ["favour"]),
    ("fulfill", ["fulfil"]),
    ("judgment", ["judgement"]),
    ("merchantability", ["merchantibility"]),
    ("noncommercial", ["non commercial"]),
    ("organization", ["organisation"]),
    ("program", ["programme"]),
    ("recognize", ["recognise"]),
    ("while", ["whilst"]),
    ("version", ["ver"]),
]

#: Notices and short licences by their public identifiers.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR "
        "IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "MIT License\n\nCopyright (c) <year> <copyright holders>\n\n"
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
]

_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TERMS = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.",
]
_ISC = (
    "Permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
    "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
    "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\n"
    "For more information, please refer to <{}>"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
    "the use of this software.\n\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
    "subject to the following restrictions:\n\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
    "product, an acknowledgment in the product documentation would be appreciated but is not required.\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n"
    "3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by '
    'this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the '
    "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\n"
    "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must "
    "be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are "
    "solely in the form of machine-executable object code generated by a source language processor.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR "
    "ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)


def _whole_texts() -> list[tuple[str, str]]:
    """The short licences with their usual titles, and without one."""
    out = [("MIT", titled) for titled in (KNOWN[-1][1].removeprefix("MIT License"), "The " + KNOWN[-1][1], KNOWN[-1][1].replace("MIT License", "The MIT License (MIT)"))]
    out += [("0BSD", f"{title}\n{KNOWN[-2][1]}") for title in ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero-Clause License (0BSD)")]
    for name, n, titles in (("BSD-2-Clause", 2, ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License']), ("BSD-3-Clause", 3, ["BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'])):
        for title in ["", *titles]:
            for rights in ("", "All rights reserved."):
                for sign in ("{}. ", "* "):
                    terms = [sign.format(k + 1) + term for k, term in enumerate(_BSD_TERMS[:n])]
                    out.append((name, "\n".join([title, rights, _BSD, *terms, _DISCLAIMER])))
    out += [("ISC", title + _ISC.format(word)) for title in ("", "ISC License\n", "The ISC License\n", "ISC License (ISC)\n") for word in ("/or", "")]
    out += [("Unlicense", title + _UNLICENSE.format(page)) for title in ("", "The Unlicense\n") for page in ("https://unlicense.org/", "http://unlicense.org/")]
    out += [("Zlib", title + _ZLIB) for title in ("", "zlib License\n", "The zlib License\n", "zlib/libpng License\n")]
    return out + [("BSL-1.0", title + _BOOST) for title in ("", "Boost Software License - Version 1.0 - August 17th, 2003\n")]


def _gnu(long: str, short: str, number: str) -> list[str]:
    names = [f"{a}{long} License{v}{number}" for a in ("GNU ", "") for v in (", version ", " v")]
    return names + [f"{a}{short}{v}{number}" for a in ("GNU ", "") for v in (" v", "v", " ")]


#: Names and short names under which notices cite a licence.
NAMES = {
    "0BSD": ["0BSD", "BSD Zero Clause", "Zero-Clause BSD"],
    "AGPL-3.0": [*_gnu("Affero General Public", "AGPL", "3"), *_gnu("Affero General Public", "AGPL", "3.0")],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0", "Apache 2", "Apache License 2", "Apache v2"],
    "BSD-2-Clause": ["BSD 2-Clause", "2-Clause BSD", "Simplified BSD", "BSD 2-Clause Simplified", "FreeBSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD", "Revised BSD", "BSD 3-Clause New or Revised"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0 1.0 Universal"],
    "GPL-2.0": [*_gnu("General Public", "GPL", "2"), *_gnu("General Public", "GPL", "2.0")],
    "GPL-3.0": [*_gnu("General Public", "GPL", "3"), *_gnu("General Public", "GPL", "3.0")],
    "ISC": ["ISC"],
    "LGPL-2.1": _gnu("Lesser General Public", "LGPL", "2.1"),
    "LGPL-3.0": [*_gnu("Lesser General Public", "LGPL", "3"), *_gnu("Lesser General Public", "LGPL", "3.0")],
    "MIT": ["MIT", "Expat", "MIT/Expat"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPL v2.0", "MPL v2"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib", "zlib/libpng"],
} | {
    f"CC-{short}-4.0": [f"CC {short} 4.0", f"Creative Commons {long} 4.0", f"Creative Commons {long} 4.0 International"]
    for short, long in {
        "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }.items()
}
_SUBJECTS = ["", *(f"This {what} is " for what in ("work", "project", "software", "program", "file"))]
_VERBS = ["Licensed under", "Released under", "Distributed under"]


def _notices() -> list[tuple[str, str]]:
    out = []
    for license, names in NAMES.items():
        out += [(license, f"{tag}: {license}") for tag in ("SPDX-License-Identifier", "License")]
        forms = {form for name in [license, *names] for form in ([name] if "License" in name.split() else [name, f"{name} License"])}
        for form in sorted(forms):
            out += [(license, f"{subject}{verb} {of}{form}") for subject in _SUBJECTS for verb in _VERBS for of in ("", "a " if license[:2] == "CC" else "the ", "the terms of the ")]
            out += [(license, f"{tag}: {form}") for tag in ("License", "Licensed")]
    return out


KNOWN += _whole_texts() + _notices()

#: A line that only states a copyright, maybe behind a comment sign.
COPYRIGHT_LINE = r"(^|\n)[ \t#*/;-]*(copyright|©|\(c\))[^\n]*"
SIGNS = r"[^\p{L}\p{N}]+"


def spellings() -> list[tuple[str, str]]:
    """(pattern, replacement) on words that have a blank of their own on either side."""
    apart = lambda words: f" {words.replace(' ', '  ')} "
    return [("|".join(map(apart, others)), apart(first)) for first, others in EQUIVALENT]


def canonical(text: Column) -> Column:
    """Canonical form: words with a blank on either side; two blanks if nothing is left."""
    out = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    out = F.regexp_replace(F.regexp_replace(out, COPYRIGHT_LINE, " "), SIGNS, "  ")
    spelled = out
    for pattern, new in spellings():
        spelled = F.regexp_replace(spelled, pattern, new)
    return F.when(out.rlike("|".join(pattern for pattern, _ in spellings())), spelled).otherwise(out)


def opening(text: Column) -> Column:
    """First three letters or digits, or a mark for a text that opens with what may be a copyright line.

    Texts of one canonical form share their opening: spellings differ later
    than that, and only copyright lines are left out.  It reads a few
    characters, so most texts are set aside before the costly form is made.
    """
    start = F.regexp_extract(text, r"^[^\p{L}\p{N}]*(?:[\p{L}\p{N}][^\p{L}\p{N}]*){1,3}", 0)
    letters = F.substring(F.lower(F.regexp_replace(start, SIGNS, "")), 1, 3)
    return F.when(text.rlike(r"(?i)^[^\p{L}\p{N}©]*(?:copyright|©|c\))"), F.lit("©")).otherwise(letters)


#: Whole texts of longer licences as published (with and without the part behind their terms, links by http and
#: https): identifier, opening and SHA-256 of the canonical form.
LONG_TEXTS = [
    ("Apache-2.0", "apa", "0713b8042820f074044ba6db157f7843927c515629ca29f677556daab4d3cf38"),
    ("Apache-2.0", "apa", "4ba36804e9f21222cf9539208665b89c8f8a9711e45b0c55838cd8667188e5b6"),
    ("Apache-2.0", "apa", "b43d993fc3f9c0309101f310828c7f00ec8c14307b1d8b00cda057bad3595eff"),
    ("Apache-2.0", "apa", "4c3a2854c0e85e048fc1a280c7e36de8f6a914f7c106b2cf108e686cdacdc646"),
    ("Artistic-1.0-Perl", "the", "2f3d769dc7523c6d7b33d67218c382c2f1bbbeb54c3752e387ae610d9a5519f8"),
    ("CC0-1.0", "cre", "107657b61f1fade4bc0feb6f787704a981c4e011753c8311ecf9401310e1b507"),
    ("GFDL-1.2", "gnu", "0dfe3356bc84300810c038b6e2771ade3f37a89aee4a47b254e60bbfc28e8139"),
    ("GFDL-1.2", "gnu", "ff19eda9f2c57fe48b52311ff82836702d97ab7ef50458859636361139a6a74a"),
    ("GFDL-1.3", "gnu", "d30a95cc10a5ddc54266cdfd732e3a200e88f4aeb1f454bfe35aa19fc7d792e9"),
    ("GFDL-1.3", "gnu", "e122c2154573688ac1533f0527dce9f3dbbc0321bddc4bb106a34e655456a55d"),
    ("GPL-1.0", "gnu", "4e9dfbd0b554e9592bfd59544c0dece19de6e249f13de3ed4d3f45fb50ec59f8"),
    ("GPL-1.0", "gnu", "174e1e4b9536908abe7c6766e01851b9db86f2d8bdcddffb0fddf2a7669c3263"),
    ("GPL-2.0", "gnu", "e14a19ad75dfddfe2094bdf479a50faf3a1b987c208c247dcb12ad53a69455b3"),
    ("GPL-2.0", "gnu", "6f1e711078b958df32cc87e5ba97055c4ff393b1a368c914e6ef56f921076533"),
    ("GPL-3.0", "gnu", "bf298f56841a9b4bb40ca9f36997d3a32af01f274a05846eaf5d89d5aae2af78"),
    ("GPL-3.0", "gnu", "26cf85f26f1953e9b59150de5b183578e20b64a1d7a79802a751afed04b4d669"),
    ("GPL-3.0", "gnu", "7256190d5c1932aede0e7a71410e68c6e01cf63d8f889ace1819028268bbe349"),
    ("GPL-3.0", "gnu", "487f9d76839a22dd3f6312a3664b75b5801531466bb1477283b3c4cb4377b224"),
    ("LGPL-2.0", "gnu", "586beb2d4154903cc68738d75b4e6426076027b419eb72b2ae0ed0add9cc8786"),
    ("LGPL-2.0", "gnu", "1d43c19c923c2873e55a8d49ef3ef6d5b1cc4e4c453302415d924237e3d923d6"),
    ("LGPL-2.1", "gnu", "2e88c50e8f4dfa9096f4a2532928385d4bc2a2ffbbd235c29d11b6e291c390c1"),
    ("LGPL-2.1", "gnu", "143ab92c79edc318fd6e6c1f531904cfb104ae83ec0738c3d10db4814a3149e1"),
    ("LGPL-3.0", "gnu", "75c0453548238c572209c39c34402efb773b13fb0d4d0d4b7956f2b8c4560f12"),
    ("MPL-1.1", "moz", "f81c8ff73f6be12b1bb801e42b5d51178c389d5e14add00e3d9f9cf99e4b767d"),
    ("MPL-1.1", "moz", "996325f83c6cf0f07397fa4cc1c229170ed172e0e2f34c2bd37a74f7fef710ec"),
    ("MPL-2.0", "moz", "1fa4707b66b6349121d85dfa9da964f3b6c706f2f2e8d63cfd3da5bd236a7a05"),
    ("MPL-2.0", "moz", "62c51abcc2d94e45f8df045fbdab6130eae72541c582fe1265194528477d2ed5"),
]


def known_digests(spark: SparkSession, licenses: list[tuple[str, str]] | DataFrame = KNOWN, more: DataFrame | None = None) -> DataFrame:
    """(license, digest, opening), one row per different canonical text; of two names the first in order stays.

    ``more`` is a licence table (license, text), for longer texts than the list holds; the list brings ``LONG_TEXTS``.
    """
    texts = licenses if isinstance(licenses, DataFrame) else spark.createDataFrame(licenses, "license string, text string")
    texts = texts if more is None else texts.select("license", "text").unionByName(more.select("license", "text"))
    form = texts.where("text IS NOT NULL").select("license", canonical(F.col("text")).alias("form")).where("form != '  '")
    known = form.select("license", F.unhex(F.sha2("form", 256)).alias("digest"), opening(F.col("form")).alias("opening"))
    if licenses is KNOWN:
        long = spark.createDataFrame(LONG_TEXTS, "license string, opening string, digest string")
        known = known.unionByName(long.withColumn("digest", F.unhex("digest")))
    return known.groupBy("digest").agg(F.min("license").alias("license"), F.min("opening").alias("opening"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``whole_license``, ``licenses`` (sorted, of whole text and lines) and ``n_notices`` (lines)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(text)
    plain = docs.select(F.col(id_col).alias("id"), key.alias("key"), text.alias("t"))
    lines = plain.select("id", "key", F.posexplode(F.split("t", "\n")).alias("place", "unit"))
    units = lines.unionByName(plain.select("id", "key", F.lit(None).cast("int").alias("place"), F.col("t").alias("unit")))
    openings = known.select("opening").unionByName(docs.sparkSession.createDataFrame([("©",)], "opening string")).distinct()
    known = known.drop("opening")
    if known.limit(KNOWN_MAX + 1).count() <= KNOWN_MAX:
        known, openings = F.broadcast(known), F.broadcast(openings)
    likely = units.withColumn("opening", opening(F.col("unit"))).join(openings, "opening", "left_semi")
    # never NULL, so the join below adds no filter on it that would run before the openings are compared
    digest = F.coalesce(F.unhex(F.sha2(canonical(F.col("unit")), 256)), F.lit(b""))
    digests = likely.select("id", "key", "place", digest.alias("digest"))
    found = (
        digests.join(known, "digest")
        .groupBy("id", "key")  # rows that repeat are gathered together
        .agg(
            F.min(F.when(F.col("place").isNull(), F.col("license"))).alias("__llm_whole"),
            F.array_sort(F.collect_set("license")).alias("__llm_all"),
            F.count_distinct("place").alias("__llm_lines"),
        )
        .withColumnsRenamed({"id": "__llm_id", "key": "__llm_found"})
    )
    rest = docs.drop("whole_license", "licenses", "n_notices").withColumn("__llm_key", key)
    joined = rest.join(found, rest[id_col].eqNullSafe(F.col("__llm_id")) & (F.col("__llm_key") == F.col("__llm_found")), "left")
    return joined.withColumns(
        {
            "whole_license": F.col("__llm_whole"),
            "licenses": F.coalesce("__llm_all", F.array().cast("array<string>")),
            "n_notices": F.coalesce("__llm_lines", F.lit(0)).cast("long"),
        }
    ).drop("__llm_key", "__llm_id", "__llm_found", "__llm_whole", "__llm_all", "__llm_lines")
