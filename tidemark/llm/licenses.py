"""Licence scan by sentences: known sentences become identifiers, and identifier sequences meet ordered rules.

A text is cut into sentences; a sentence is lower-cased, its marks dropped and spelling variants made one, and looked up among
the known licence sentences. What a text says about licences is then a short sequence of identifiers in order. Rules are tried
in their order, long texts before short references; a rule takes the identifiers that it matches out of the sequence, so that
a grant inside a full licence text is not found again. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import columns_of

# Known sentences, as patterns on the normalised sentence (lower case; letters, digits, dots within numbers and
# plus signs; "licence" spelled "license"), with their identifiers.
SENTENCES = [
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("bsd-redistribute", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("bsd-source", r"(?:[0-9]+ )?redistributions of source code must retain the above copyright notice.*"),
    ("bsd-binary", r"(?:[0-9]+ )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd-endorse", r"(?:[0-9]+ )?neither the name of .* may be used to endorse or promote products derived from this software.*"),
    ("asis", r"(?:the|this) software is provided (?:by .* )?as is (?:without warranty of any kind|and any express or implied warranties).*"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose including commercial applications.*"),
    ("apache-2.0", r".*(?:licensed|released|distributed|available) under (?:the )?apache(?: software)? license,?(?: version)? 2(?:\.0)?.*"),
    ("apache-comply", r"you may not use this file except in compliance with the license"),
    ("apache-obtain", r"you may obtain a copy of the license at.*"),
    ("apache-asis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("agpl-3-later", r".*gnu affero general public license.* version 3.* or (?:at your option )?any later version.*"),
    ("agpl-3", r".*(?:under|terms of) (?:the )?gnu affero general public license(?: as published by the free software foundation)?,?(?: either)? version 3.*"),
    ("lgpl-later", r".*gnu (?:lesser|library) general public license.* version (?:2|2\.1|3)\b.* or (?:at your option )?any later version.*"),
    ("lgpl-3", r".*(?:under|terms of) (?:the )?gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 3.*"),
    ("lgpl-2.1", r".*(?:under|terms of) (?:the )?gnu (?:lesser|library) general public license(?: as published by the free software foundation)?(?: either)? version 2.*"),
    ("gpl-3-later", r".*gnu general public license.* version 3.* or (?:at your option )?any later version.*"),
    ("gpl-2-later", r".*gnu general public license.* version 2.* or (?:at your option )?any later version.*"),
    ("gpl-3", r".*(?:under|terms of) (?:the )?gnu general public license(?: as published by the free software foundation)?(?: either)? version 3.*"),
    ("gpl-2", r".*(?:under|terms of) (?:the )?gnu general public license(?: as published by the free software foundation)?(?: either)? version 2.*"),
    ("gpl-any", r".*(?:under|terms of) (?:the )?gnu general public license.*"),
    ("gpl-warranty", r"this (?:program|library) is distributed in the hope that it will be useful.*"),
    ("gpl-copy", r"you should have received a copy of the gnu .* license.*"),
    ("mpl-2.0", r".*subject to the terms of the mozilla public license v(?:ersion)? ?\.? ?2\.0.*|.*under (?:the )?mozilla public license(?: version)? 2\.0.*"),
    ("cc0", r".*(?:cc0(?: 1\.0)?|creative commons zero).*"),
    ("cc-by-nc-nd", r".*(?:under|terms of) (?:a |the )?(?:cc|creative commons) (?:by nc nd|attribution noncommercial noderiv\w*).*"),
    ("cc-by-nc-sa", r".*(?:under|terms of) (?:a |the )?(?:cc|creative commons) (?:by nc sa|attribution noncommercial sharealike).*"),
    ("cc-by-nc", r".*(?:under|terms of) (?:a |the )?(?:cc|creative commons) (?:by nc|attribution noncommercial).*"),
    ("cc-by-sa", r".*(?:under|terms of) (?:a |the )?(?:cc|creative commons) (?:by sa|attribution sharealike).*"),
    ("cc-by-nd", r".*(?:under|terms of) (?:a |the )?(?:cc|creative commons) (?:by nd|attribution noderiv\w*).*"),
    ("cc-by", r".*(?:under|terms of) (?:a |the )?(?:cc|creative commons) (?:by|attribution).*"),
    ("mit", r".*(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit(?: license)?.*"),
    ("isc", r".*(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?isc(?: license)?.*"),
    ("bsd", r".*(?:licensed|released|distributed|available) under (?:the |a )?(?:terms of the )?(?:new |modified |simplified |[234] clause )?bsd.*"),
    ("public-domain", r".*(?:released|placed|dedicated) (?:in|into|to) the public domain.*"),
    ("reserved", r".*all rights reserved.*"),
    ("mention", r".*\b(?:license|licensed|licensing|copyright)\b.*"),
]

# Ordered rules, a licence and the identifiers that stand one after another for it.
RULES = [
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse", "asis"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "asis"]),
    ("MIT", ["mit-grant", "mit-notice", "asis"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant", "asis"]),
    ("Zlib", ["zlib-grant"]),
    ("Apache-2.0", ["apache-2.0", "apache-comply", "apache-obtain", "apache-asis"]),
    ("Apache-2.0", ["apache-2.0"]),
    ("AGPL-3.0-or-later", ["agpl-3-later"]),
    ("AGPL-3.0", ["agpl-3"]),
    ("LGPL-or-later", ["lgpl-later"]),
    ("LGPL-3.0", ["lgpl-3"]),
    ("LGPL-2.1", ["lgpl-2.1"]),
    ("GPL-3.0-or-later", ["gpl-3-later", "gpl-warranty", "gpl-copy"]),
    ("GPL-3.0-or-later", ["gpl-3-later"]),
    ("GPL-2.0-or-later", ["gpl-2-later", "gpl-warranty", "gpl-copy"]),
    ("GPL-2.0-or-later", ["gpl-2-later"]),
    ("GPL-3.0", ["gpl-3"]),
    ("GPL-2.0", ["gpl-2"]),
    ("GPL", ["gpl-any"]),
    ("MPL-2.0", ["mpl-2.0"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-NC-ND", ["cc-by-nc-nd"]),
    ("CC-BY-NC-SA", ["cc-by-nc-sa"]),
    ("CC-BY-NC", ["cc-by-nc"]),
    ("CC-BY-SA", ["cc-by-sa"]),
    ("CC-BY-ND", ["cc-by-nd"]),
    ("CC-BY", ["cc-by"]),
    ("MIT", ["mit"]),
    ("ISC", ["isc"]),
    ("BSD", ["bsd"]),
    ("Public-Domain", ["public-domain"]),
    ("All-Rights-Reserved", ["reserved"]),
]
#: Words that one alternative of every pattern above needs, as they stand in a normalised sentence. In a raw text a space is any
#: run of characters that become one.
NEEDED = (
    r"licens|copyright|permission|redistribution|software is provided|distributed in the hope|neither the name of|as is|"
    r"(?:under|of|a|the) (?:cc|creative commons) |cc0|creative commons zero|(?:under|the|of) (?:mit|isc)(?![a-z])|bsd|"
    r"the public domain|all rights reserved"
)
RAW_NEEDED = NEEDED.replace("licens", "licen[cs]").replace(" ", "[^a-z0-9+]+")
#: The filter of the checking SQL. It is narrower than the patterns: the SQL misses short references without these words.
CLUE = r"(?i)licen[cs]e|copyright|permi(?:ssion|tted)|redistribut|warrant|as is|public domain|rights reserved|cc0|creative commons|endorse|you may not use this"
#: Licences that allow use in training without further terms.
OPEN = ["MIT", "ISC", "Zlib", "Apache-2.0", "BSD", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY", "Public-Domain"]

# Sentence ends: a mark and white space, or an empty line. Other line ends are spaces, since long sentences are broken over lines.
END = r"([.!?;:])\s+|\s*\n\s*\n\s*"


def sentences(text: Column) -> Column:
    """Normalised sentences. A line that is a sentence by itself ends with a mark, so that it is cut there; headings and lists
    end at an empty line."""
    cut = F.regexp_replace(text, END, "$1\n\n")
    low = F.lower(cut)
    plain = F.regexp_replace(low, r"[^a-z0-9.+\n]+|(?<![0-9])\.|\.(?![0-9])|(?<!\n)\n(?!\n)", " ")
    plain = F.replace(plain, F.lit("licence"), F.lit("license"))
    return F.transform(F.split(plain, r"\n\n"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))


def identifier(sentence: Column) -> Column:
    """The identifier of a normalised sentence; null for one that says nothing about licences."""
    known = F.lit(None).cast("string")
    for name, pattern in reversed(SENTENCES):
        known = F.when(sentence.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(known)
    return F.when(sentence.rlike(NEEDED), known)


def matched(sequence: Column) -> Column:
    """(rest, found): the licences of a sequence written as |a|b|, and what no rule took. One rule takes all its places."""
    rules = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{i}|" for i in ids)).alias("ids")) for name, ids in RULES
    ])
    none = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        return F.when(
            F.contains(state["rest"], rule["ids"]),
            F.struct(
                F.replace(state["rest"], rule["ids"], F.lit("")).alias("rest"),
                F.array_union(state["found"], F.array(rule["name"])).alias("found"),
            ),
        ).otherwise(state)

    return F.aggregate(rules, none, step)


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, the identifiers of its licence sentences in order, its licences by name, how many licence
    sentences no rule took, and whether all licences are open ones.

    Null and empty texts have none; ``open`` is null where no licence is found. Rows are taken one by one. No rows give none.
    """
    own = columns_of(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = F.filter(F.transform(sentences(F.col("text")), identifier), lambda i: i.isNotNull())
    said = own.select("doc_id", F.when(F.lower("text").rlike(RAW_NEEDED), ids).otherwise(F.array().cast("array<string>")).alias("ids"))
    line = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    made = said.select("doc_id", "ids", matched(line).alias("m"))
    names = F.array_sort("m.found")
    return made.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(names, ",").alias("licenses"),
        (F.length("m.rest") - F.length(F.replace("m.rest", F.lit("|"), F.lit("")))).cast("bigint").alias("_marks"),
        F.when(F.size(names) > 0, F.forall(names, lambda n: n.isin(OPEN))).alias("open"),
    ).select("doc_id", "n_sentences", "sentence_ids", "licenses", (F.col("_marks") / 2).cast("bigint").alias("n_unmatched"), "open")


def check_sql() -> str:
    """The scan as SQL: sentences as rows, the first known pattern of each, and the rules one after another."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    cases = " ".join(f"WHEN regexp_full_match(s, {quoted(p)}) THEN {quoted(n)}" for n, p in SENTENCES)
    steps, rest = [], "seq"
    for k, (_, ids) in enumerate(RULES):
        mark = quoted("".join(f"|{i}|" for i in ids))
        steps += [f"contains({rest}, {mark}) AS m{k}", f"replace({rest}, {mark}, '') AS r{k}"]
        rest = f"r{k}"
    names = ", ".join(f"CASE WHEN m{k} THEN {quoted(n)} END" for k, (n, _) in enumerate(RULES))
    opened = ", ".join(map(quoted, OPEN))
    return rf"""WITH cut AS (
          SELECT doc_id, unnest(string_split(replace(lower(regexp_replace(coalesce(text, ''), '([.!?;:])\s+|\s*\n\s*\n\s*', '\1' || chr(10) || chr(10), 'g')),
                 'licence', 'license'), chr(10) || chr(10))) AS raw, generate_subscripts(string_split(regexp_replace(coalesce(text, ''),
                 '([.!?;:])\s+|\s*\n\s*\n\s*', '\1' || chr(10) || chr(10), 'g'), chr(10) || chr(10)), 1) AS place
          FROM documents),
        dots AS (SELECT doc_id, place, regexp_replace(regexp_replace(raw, '[^a-z0-9.+]+', ' ', 'g'), '([0-9])\.([0-9])', '\1#\2', 'g') AS d FROM cut),
        plain AS (SELECT doc_id, place, trim(regexp_replace(replace(regexp_replace(regexp_replace(d, '([0-9])\.([0-9])', '\1#\2', 'g'), '\.', ' ', 'g'), '#', '.'), '\s+', ' ', 'g')) AS s FROM dots),
        known AS (SELECT doc_id, place, CASE {cases} END AS id FROM plain WHERE regexp_matches(s, {quoted(CLUE)})),
        said AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY place) AS ids, string_agg('|' || id || '|', '' ORDER BY place) AS seq
                 FROM known WHERE id IS NOT NULL GROUP BY doc_id),
        ruled AS (SELECT *, {", ".join(steps)} FROM said),
        named AS (SELECT doc_id, n, ids, length({rest}) - length(replace({rest}, '|', '')) AS marks,
                  list_sort(list_distinct(list_filter([{names}], lambda x: x IS NOT NULL))) AS found FROM ruled)
        SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(array_to_string(found, ','), '') AS licenses,
               CAST(coalesce(marks, 0) // 2 AS BIGINT) AS n_unmatched,
               CASE WHEN len(found) > 0 THEN len(list_filter(found, lambda x: x NOT IN ({opened}))) = 0 END AS open
        FROM documents d LEFT JOIN named USING (doc_id)"""
