"""Licences of files: sparse TF-IDF cosines to templates, and inheritance along directories. DataFrame functions only.

A unit is a whole text (a licence file), or a header: a sentence of a line or of a paragraph, or two or three neighbouring
lines, without comment signs. Its tokens are weighted by their rarity among
the templates and joined with the templates' tokens; sums per unit and template give cosines. Few units need that: a
cosine of ``threshold`` takes one of a few tokens of a template, for the others, its function words above all, are too short
a vector without them. This filter is exact, but that function words alone, however many, make no notice. Directories that hold a licence file (a text that is a notice, or a file of such a name with a header) pass its licence on to the files below that have none
of their own, the nearest directory first, by joins on directory paths. Licences that differ by a clause are told apart by it; SPDX tags are
read as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatelens.llm.common import saved

# Bodies and notices of well-known licences, by identifier.
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."""
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright, CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
    # What full texts begin with, and the usual headers of source files.
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-2-Clause", f"{_BSD_2}\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_2}\n{_BSD_3}\n{_BSD_END}"),
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("Unlicense", _UNLICENSE),
)
# Near relations share most of their words; a clause tells them apart. Words of a clause may stand in different comment lines.
_GAP = r"[\s*#/;%-]++"
TWO_CLAUSES = rf"(?i)redistributions{_GAP}in{_GAP}binary{_GAP}form"
THIRD_CLAUSE = rf"(?i)endorse{_GAP}or{_GAP}promote"
SPDX = r"SPDX-License-Identifier:[ \t]*+\(?([A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)"
#: A directory's files are dealt so many ways where they meet its licence.
SALTS = 32
# Signs that begin or end lines of comments, and names of files that hold licences.
# Repeated groups are possessive: nothing follows them, and a long run then takes no stack.
COMMENT = r"(?im)^[ \t]*(?:(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--|dnl\b|rem\b)[ \t]*+)*+|[ \t\r]*(?:\*+/|-->)?[ \t\r]*$"
LICENSE_FILE = r"(?i)(?:^|/)(?:(?:un)?licen[cs]es?|copying|copyright)(?:[._-][^/]*)?$"
# Function words of several languages, which tell no licence and are in every text.
COMMON = frozenset(
    "a all an and any are as at be been but by can could did do for from had has have he her his how i if in into is it its may more no not of on one "
    "or other our out shall she so some such than that the their them there these they this to under up was we were what when which who will with without would you your "
    "das de der des die ein eine el en es et im ist la las le les los mit para por pour que se sur un una und une von y zu".split()
)
TOKEN = r"[a-z0-9]++(?:[.+-][a-z0-9]++)*+"


class _Vectors:
    """The templates as unit vectors, and the tokens without which no cosine reaches the threshold."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float):
        counts = [Counter(re.findall(TOKEN, text.lower())) for _, text in templates]
        spread = Counter(t for c in counts for t in c)
        self.rarity = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in spread.items()}
        self.unseen = math.log(1 + len(templates)) + 1
        self.rows, needed = [], set()
        for k, ((name, _), c) in enumerate(zip(templates, counts, strict=True)):
            weights = {t: n * self.rarity[t] for t, n in c.items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            rest = 0.0  # squared length of the tokens that can be missed: function words and numbers first, then light ones
            for token, w in sorted(weights.items(), key=lambda x: (not (x[0] in COMMON or x[0][0].isdigit()), x[1], x[0])):
                self.rows.append((token, k, name, w / norm))
                rest += (w / norm) ** 2
                if rest >= (threshold - 1e-9) ** 2 and token not in COMMON:  # together with this one they could reach the threshold
                    needed.add(token)
        self.needed = "(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(t) for t in sorted(needed)) + ")(?![a-z0-9])"


def scan_licenses(
    files: DataFrame, path: str, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.75, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The licence of each file: (id_column, path, license, basis, similarity, source_dir), one row per row of ``files``.

    ``path`` names the column with paths (parts joined by ``/``). ``basis`` is ``file`` (the whole text is a notice),
    ``header`` (a sentence or some neighbouring lines are), ``inherited`` (neither, but a directory on the way up holds a licence file, that is one of basis ``file``, or one named
    like LICENSE or COPYING with a header; ``source_dir``
    is the nearest) or null. An SPDX tag is a header of similarity 1 that goes before others; of its expression the first
    identifier counts, without ``-only``, ``-or-later`` and ``+``. A file with several notices has that of the highest similarity, then the first by name.

    Defined cases: null and empty texts have no notice of their own but may inherit. A null path stays null and neither
    gives nor inherits. Null ids stay null; repeated rows are judged each; of several licence files in a directory the
    most similar counts, then the first licence by name. An empty table gives an empty result, no templates give no licence. Other
    columns, whatever their names, play no part.
    """
    spark = files.sparkSession
    vectors = _Vectors(templates, threshold)
    text = F.coalesce(F.col(text_column), F.lit(""))
    concerned = text.rlike(vectors.needed) if templates else F.lit(False)
    bare = F.regexp_replace(text, COMMENT, "")
    paragraphs = F.regexp_replace(bare, r"(?<=[^\n])\n(?=[^\n])", " ")
    sentences = F.flatten(F.transform(F.filter(F.concat(F.split(text, "\n"), F.split(paragraphs, "\n")), lambda x: x.rlike(vectors.needed)), lambda x: F.split(x, r"(?<=[.!?;])\s+")))
    neighbours = [F.regexp_extract_all(bare, F.lit(r"(?m)^(?=([^\n]+" + r"\n[^\n]+" * n + ")$)"), F.lit(1)) for n in (1, 2)]
    headers = F.filter(F.concat(sentences, *neighbours), lambda x: x.rlike(vectors.needed))
    units = F.concat(F.array(text), F.array_distinct(headers))
    tokens = F.transform(units, lambda u: F.regexp_extract_all(F.lower(u), F.lit(TOKEN), F.lit(0)))
    rows = files.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(path).cast("string").alias("path"),
        F.when(concerned, tokens).otherwise(F.array().cast("array<array<string>>")).alias("units"),
        F.when(concerned & text.rlike(THIRD_CLAUSE), "BSD-3-Clause").when(concerned & text.rlike(TWO_CLAUSES), "BSD-2-Clause").alias("relation"),
        F.when(F.lit(bool(templates)) & text.contains("SPDX-License-Identifier:"), F.nullif(F.regexp_replace(F.regexp_extract(text, SPDX, 1), r"(?:-only|-or-later|\+)$", ""), F.lit(""))).alias("tag"),
    )
    rows = saved(rows.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), ""))))

    weights = spark.createDataFrame(vectors.rows, "token string, template int, license string, weight double")
    rarity = spark.createDataFrame(list(vectors.rarity.items()), "token string, rarity double")
    counted = (
        rows.select("row", F.posexplode("units").alias("unit", "tokens")).select("row", "unit", F.explode("tokens").alias("token"))
        .groupBy("row", "unit", "token").agg(F.count("*").alias("n"))
        .join(rarity, "token", "left").withColumn("w", F.col("n") * F.coalesce("rarity", F.lit(vectors.unseen)))
    )
    # One row per token and template; a token of no template counts for the length only.
    norms = counted.groupBy("row", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = counted.where("rarity is not null").join(weights, "token").groupBy("row", "unit", "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    similar = dots.join(norms, ["row", "unit"]).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("similarity") >= threshold)
    best = F.min(F.struct((F.col("unit") > 0).alias("header"), (-F.col("similarity")).alias("minus"), F.col("license")))
    own = similar.groupBy("row").agg(best.alias("best")).select(
        "row", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("similarity"), F.when(F.col("best.header"), "header").otherwise("file").alias("basis")
    )
    own = rows.select("row", "id", "path", "dir", "relation", "tag").join(own, "row", "left")
    tagged = F.col("tag").isNotNull() & ~F.col("basis").eqNullSafe("file")
    judged = saved(
        own.select(
            "row", "id", "path", "dir",
            F.when(tagged, F.col("tag")).when(F.col("license").startswith("BSD-"), F.coalesce("relation", "license")).otherwise(F.col("license")).alias("license"),
            F.when(tagged, 1.0).otherwise(F.col("similarity")).alias("similarity"),
            F.when(tagged, "header").otherwise(F.col("basis")).alias("basis"),
        )
    )

    gives = (F.col("basis") == "file") | ((F.col("basis") == "header") & F.col("path").rlike(LICENSE_FILE))
    givers = judged.where(gives & F.col("dir").isNotNull()).groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("minus"), "license")).alias("g"))
    givers = givers.select(F.col("dir").alias("source_dir"), F.col("g.license").alias("given"), (-F.col("g.minus")).alias("given_similarity"))
    # Directories, not files, climb: one row per directory and ancestor.
    parts = F.split("dir", "/")
    upward = judged.where("license is null and dir is not null").select("dir").distinct().select(
        "dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("source_dir")
    )
    deepest = F.row_number().over(Window.partitionBy("dir").orderBy(F.desc(F.length("source_dir"))))
    nearest = upward.distinct().join(givers, "source_dir").withColumn("rank", deepest).where("rank = 1").drop("rank")
    # A directory may hold any share of all files: they meet its licence in several tasks.
    nearest = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    judged = judged.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    return judged.join(nearest, ["dir", "salt"], "left").select(
        F.col("id").alias(id_column), "path",
        F.coalesce("license", "given").alias("license"),
        F.coalesce("basis", F.when(F.col("given").isNotNull(), "inherited")).alias("basis"),
        F.coalesce("similarity", "given_similarity").alias("similarity"),
        F.when(F.col("license").isNull(), F.col("source_dir")).alias("source_dir"),
    )
