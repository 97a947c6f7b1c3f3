"""License scans by sentence rules, with DataFrame functions only.

A text is cut into sentences twice: at every line end and sentence end, and at blank lines and sentence ends only, so that
sentences wrapped over lines are whole in the second. Sentences are normalised (lower case; everything but
letters a-z and digits is one blank) and mapped to identifiers of known license sentences; others are skipped. The
identifiers of a text, in order, are matched with rules: a rule is an ordered sequence of identifiers and names a license; it
matches where its sequence occurs without a gap. A rule inside a longer one that matched says nothing more.

Everything happens within a row: no join, no shuffle. Texts without any word that all known sentences share (``TRIGGER``) are
passed over before they are cut. Null and empty texts have no identifiers and no license.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Normalised sentences of common license texts and notices as ``sentences`` leaves them, and their identifiers. Where
#: a text on one line makes one sentence of several, it has the identifiers of all of them.
SENTENCES = {
    "released under the mit license": "mit-note",
    "licensed under the mit license": "mit-note",
    "this project is licensed under the mit license": "mit-note",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
    "the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache-2-note",
    "licensed under the apache license version 2 0 the license": "apache-2-note",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2-note,apache-2-use",
    "you may not use this file except in compliance with the license": "apache-2-use",
    "you may obtain a copy of the license at": "apache-2-copy",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-2-copy",
    "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
    "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or "
    "implied": "apache-2-copy,apache-2-warranty",
    "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
    "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or "
    "implied": "apache-2-warranty",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache-2-copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
    "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or "
    "implied": "apache-2-copy,apache-2-warranty",
    "https www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
    "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or "
    "implied": "apache-2-warranty",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied": "apache-2-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-2-see",
    "this work is licensed under the gnu general public license version 3": "gpl-3-note",
    "licensed under the gnu general public license version 3": "gpl-3-note",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
    "foundation either version 3 of the license or at your option any later version": "gpl-3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
    "foundation either version 2 of the license or at your option any later version": "gpl-2-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
    "merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
    "are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution": "bsd-binary",
    "licensed under cc by nc 4 0": "cc-by-nc-4-note",
    "licensed under cc by 4 0": "cc-by-4-note",
    "licensed under cc by sa 4 0": "cc-by-sa-4-note",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-note",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-note",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4-note",
    "all rights reserved": "reserved",
}

#: Fixed value: how a sentence ends that names any holder, and its identifier. A holder like "A. Inc." ends a sentence, so the ending may be all of it.
ENDING = "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
ENDING_ID = "bsd-names"

#: Ordered rules, longer ones first. First sentences may be lost to a copyright line before them on the same line.
RULES = [
    ("Apache-2.0", ["apache-2-note", "apache-2-use", "apache-2-copy", "apache-2-warranty", "apache-2-see"]),
    ("GPL-3.0-or-later", ["gpl-3-grant", "gpl-warranty", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl-2-grant", "gpl-warranty", "gpl-see"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-names"]),
    ("MIT", ["mit-notice", "mit-warranty"]),
    ("BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    ("GPL-3.0-or-later", ["gpl-3-grant"]),
    ("GPL-2.0-or-later", ["gpl-2-grant"]),
    ("MIT", ["mit-note"]),
    ("Apache-2.0", ["apache-2-note"]),
    ("GPL-3.0-only", ["gpl-3-note"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-note"]),
    ("CC-BY-4.0", ["cc-by-4-note"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-note"]),
    ("LicenseRef-proprietary", ["reserved"]),
]

#: Every known sentence has one of these words.
TRIGGER = r"licens|permi|warrant|rights\s+reserved|redistribut|copyright"


def patterns() -> list[tuple[str, str, list[str]]]:
    """(license, sequence as text, sequences that it covers) of each rule."""
    texts = ["," + ",".join(r) + "," for _, r in RULES]
    return [(name, t, [o for o in texts if o != t and o in t]) for (name, _), t in zip(RULES, texts)]


def sentences(text: F.Column, breaks: str) -> F.Column:
    """Normalised sentences; ``breaks`` is the pattern of line ends that end a sentence too."""
    marked = F.regexp_replace(F.regexp_replace(F.lower(text), r"([.!?:])[ \t\r\n]+", "$1\u0001"), breaks, "\u0001")
    return F.transform(F.split(marked, "\u0001"), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))


def identifiers(text: F.Column, breaks: str) -> F.Column:
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    ends = lambda s: (s == ENDING) | F.endswith(s, F.lit(" " + ENDING))
    found = F.filter(F.transform(sentences(text, breaks), lambda s: F.when(ends(s), ENDING_ID).otherwise(F.try_element_at(known, s))), lambda x: x.isNotNull())
    return F.coalesce(F.concat_ws(",", found), F.lit(""))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with sentence_ids (comma-joined identifiers in order) and licenses (sorted, comma-joined; empty: none)."""
    seen = F.lower(F.col(text)).rlike(TRIGGER)
    rows = df.withColumns({
        "_lines": F.when(seen, identifiers(F.col(text), r"[\r\n]+")).otherwise(F.lit("")),
        "_blocks": F.when(seen, identifiers(F.col(text), r"\r?\n[ \t]*\r?\n")).otherwise(F.lit(""))})
    # the cut with more identifiers tells more; line by line where both tell as much
    count = lambda c: F.when(F.col(c) == "", 0).otherwise(F.size(F.split(c, ",")))
    rows = rows.withColumn("sentence_ids", F.when(count("_blocks") > count("_lines"), F.col("_blocks")).otherwise(F.col("_lines")))
    sides = [F.concat(F.lit(","), F.col(x), F.lit(",")) for x in ("_lines", "_blocks")]
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("seq"), F.array(*[F.lit(o) for o in covered]).cast("array<string>").alias("covers"))
                      for n, t, covered in patterns()])
    matched = F.filter(rules, lambda r: F.contains(sides[0], r["seq"]) | F.contains(sides[1], r["seq"]))
    rows = rows.withColumn("_rules", F.when((F.col("_lines") == "") & (F.col("_blocks") == ""), None).otherwise(matched))
    own = F.filter("_rules", lambda r: ~F.exists("_rules", lambda o: F.array_contains(o["covers"], r["seq"])))
    names = F.array_sort(F.array_distinct(F.transform(own, lambda r: r["name"])))
    return rows.withColumn("licenses", F.coalesce(F.concat_ws(",", names), F.lit(""))).drop("_lines", "_blocks", "_rules")


def check_sql() -> str:
    """The same in DuckDB's SQL over ``documents``."""
    known = "map {" + ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items()) + "}"
    rules = ", ".join(f"{{'name': '{n}', 'seq': '{t}', 'covers': [{', '.join(repr(o) for o in covered)}]::varchar[]}}" for n, t, covered in patterns())

    def ids(breaks: str) -> str:
        marked = f"regexp_replace(regexp_replace(lower(text), '([.!?:])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), '{breaks}', chr(1), 'g')"
        cut = f"list_transform(string_split({marked}, chr(1)), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))"
        named = f"list_filter(list_transform({cut}, lambda s: case when s = '{ENDING}' or suffix(s, ' {ENDING}') then '{ENDING_ID}' else {known}[s] end), lambda x: x is not null)"
        return f"case when regexp_matches(lower(text), '{TRIGGER}') then coalesce(array_to_string({named}, ','), '') else '' end"

    return f"""
with cut as (select doc_id, {ids(r'[\r\n]+')} as a, {ids(r'\r?\n[ \t]*\r?\n')} as b from documents),
matched as (select *, list_filter([{rules}], lambda r: contains(',' || a || ',', r.seq) or contains(',' || b || ',', r.seq)) as m from cut),
own as (select *, list_filter(m, lambda r: not list_contains(flatten(list_transform(m, lambda o: o.covers)), r.seq)) as o from matched)
select doc_id,
  case when len(string_split(b, ',')) > len(string_split(a, ',')) or (a = '' and b <> '') then b else a end as sentence_ids,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(o, lambda r: r.name))), ','), '') as licenses
from own"""
