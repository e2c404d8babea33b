"""License scans: normalised sentences become licence-sentence identifiers, ordered rules match their sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The known sentences, normalised (lower case, runs of other than a-z 0-9 as one space), and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2_licensed",
    "licensed under the apache license version 2 0 the license": "apache2_licensed",
    "you may not use this file except in compliance with the license": "apache2_compliance",
    "you may obtain a copy of the license at": "apache2_copy",
    "http www apache org licenses license 2 0": "apache2_url",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2_copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2_as_is",
    "see the license for the specific language governing permissions and limitations under the license": "apache2_see",
    "released under the mit license": "mit_released",
    "licensed under the mit license": "mit_released",
    "this project is licensed under the mit license": "mit_released",
    "the mit license": "mit_title",
    "the mit license mit": "mit_title",
    "mit license": "mit_title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_as_is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit_liability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_endorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "this work is licensed under the gnu general public license version 3": "gpl3_licensed",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_useful",
    "see the gnu general public license for more details": "gpl_see",
    "you should have received a copy of the gnu general public license along with this program": "gpl_copy",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2_subject",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "mpl2_copy",
    "licensed under cc by nc 4 0": "cc_by_nc4_licensed",
    "licensed under cc by 4 0": "cc_by4_licensed",
    "licensed under cc by sa 4 0": "cc_by_sa4_licensed",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc_by4_licensed",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc_by_nc4_licensed",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc_by_sa4_licensed",
    "this is free and unencumbered software released into the public domain": "unlicense_public",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense_anyone",
    "all rights reserved": "all_rights_reserved",
}

#: Licences and, for each, the ordered sentences one of its rules takes; a rule's sentences follow one another among the recognised ones.
RULES = [
    ("Apache-2.0", ("apache2_licensed",)),
    ("Apache-2.0", ("apache2_compliance", "apache2_copy")),
    ("Apache-2.0", ("apache2_as_is", "apache2_see")),
    ("MIT", ("mit_released",)),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_title", "mit_grant")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "mit_as_is")),
    ("ISC", ("isc_grant",)),
    ("GPL-3.0-only", ("gpl3_licensed",)),
    ("GPL-3.0-or-later", ("gpl3_later", "gpl_useful")),
    ("GPL-2.0-or-later", ("gpl2_later", "gpl_useful")),
    ("MPL-2.0", ("mpl2_subject", "mpl2_copy")),
    ("CC-BY-NC-4.0", ("cc_by_nc4_licensed",)),
    ("CC-BY-4.0", ("cc_by4_licensed",)),
    ("CC-BY-SA-4.0", ("cc_by_sa4_licensed",)),
    ("Unlicense", ("unlicense_public", "unlicense_anyone")),
]

#: Known sentences and rules that the SQL does not have.
MORE_SENTENCES = {
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd_as_is",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2_copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2_copy",
}
MORE_RULES = [("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is"))]

#: The SQL's sentences end at a full stop, question or exclamation mark before white space, and at line ends.
BREAK = "[.!?]+[\\x20\\x09\\x0B-\\x0D]+|[.!?]*\\n+"
#: Where no sentence goes on: list marks at a line's start, lines without a letter or digit, sentence marks before white space.
HARD = r"\n[^a-z0-9]*\(?[a-z0-9]{1,2}\)[\x20\x09]+|\n[^a-z0-9\n]*(?=\n)|[.!?]+(?=[^a-z0-9\n]*\n)|[.!?]+[\x20\x09\x0B-\x0D]+"


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """(id_col, sentence_ids, licenses) of each row with a recognised sentence, ids in text order.

    ``licenses`` has the sorted names of the licences with a matching rule; it is empty if sentences were
    recognised but complete no rule. A sentence is recognised whole, wherever it stands, on one line or wrapped
    over lines with or without comment marks; it starts and ends at a sentence mark, a line end or a list mark. Rules are
    matched against the recognised sentences only, so other text may stand between. Rows without a
    recognised sentence, null and empty texts give no row; repeated rows give one each; other columns
    are not read. All of it is built-in functions: the known sentences are a map literal of fixed size,
    each row is handled on its own, and nothing is shuffled.
    """
    known = sentences or SENTENCES | MORE_SENTENCES
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    # in lower case, S and L are free to mark breaks and line ends
    norm = F.regexp_replace(F.lower(F.col(text_ref(text_col))), r"\bv\.[\x20\x09]*\n?[^a-z0-9\n.!?]*(?=[0-9])", "v ")
    norm = F.regexp_replace(F.regexp_replace(norm, HARD, " S "), r"\n", " L ")
    norm = F.concat(F.lit("S "), F.trim(F.regexp_replace(norm, "[^a-z0-9SL]+", " ")), F.lit(" S"))
    # the shorter first: what ends at a line end is not joined with the next line
    any_known = "|".join(k.replace(" ", "(?: L)? ") for k in sorted(known, key=len))
    found = F.regexp_extract_all(norm, F.lit(f"(?<=[SL] )({any_known})(?= [SL])"), F.lit(1))
    hits = F.transform(found, lambda m: F.element_at(table, F.replace(m, F.lit(" L"), F.lit(""))))
    line = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    names = F.array(*[F.when(line.contains(" " + " ".join(seq) + " "), F.lit(name)) for name, seq in rules or RULES + MORE_RULES])
    found = df.select(F.col(id_col), hits.alias("sentence_ids")).where(F.size("sentence_ids") > 0)
    return found.withColumn("licenses", F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isNotNull()))))


def text_ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql(pattern: str) -> str:
    """A pattern inside an SQL string literal."""
    return pattern.replace("\\", "\\\\").replace("'", "\\'")
