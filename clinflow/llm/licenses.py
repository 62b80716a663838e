"""Licences named or quoted in texts, by their sentences.

A text is cut into sentences, each is brought to a plain form and looked up among known sentences of
licences; the order of the known ones is then matched against the rules, which are sequences of
them. Only built-in functions are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import whole_row

# Sentences of public licences and of usual notices, in plain form, by number.
SENTENCES = {
    3: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",  # noqa: E501
    4: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",  # noqa: E501
    5: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",  # noqa: E501
    6: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",  # noqa: E501
    7: "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",  # noqa: E501
    9: "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",  # noqa: E501
    10: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    11: "you may obtain a copy of the license at",
    12: "http www apache org licenses license 2 0",
    13: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",  # noqa: E501
    14: "see the license for the specific language governing permissions and limitations under the license",  # noqa: E501
    17: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",  # noqa: E501
    18: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",  # noqa: E501
    19: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",  # noqa: E501
    20: "see the gnu general public license for more details",
    21: "you should have received a copy of the gnu general public license along with this program",
    28: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",  # noqa: E501
    29: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",  # noqa: E501
    30: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",  # noqa: E501
    31: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",  # noqa: E501
    32: "this is free and unencumbered software released into the public domain",
    33: "all rights reserved",
    51: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",  # noqa: E501
    52: "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",  # noqa: E501
    53: "this source code form is subject to the terms of the mozilla public license v 2 0",
    54: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    55: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",  # noqa: E501
    56: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",  # noqa: E501
    57: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",  # noqa: E501
}
# Names of licences in notices ("licensed under the ..."), in plain form.
NAMES = {
    "mit license": "MIT",
    "mit": "MIT",
    "isc license": "ISC",
    "apache license version 2 0": "Apache-2.0",
    "apache license 2 0": "Apache-2.0",
    "apache 2 0 license": "Apache-2.0",
    "bsd 2 clause license": "BSD-2-Clause",
    "2 clause bsd license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause",
    "3 clause bsd license": "BSD-3-Clause",
    "mozilla public license version 2 0": "MPL-2.0",
    "mozilla public license 2 0": "MPL-2.0",
    "gnu general public license version 2": "GPL-2.0",
    "gnu general public license version 3": "GPL-3.0",
    "gnu general public license v2 0": "GPL-2.0",
    "gnu general public license v3 0": "GPL-3.0",
    "gplv2": "GPL-2.0",
    "gplv3": "GPL-3.0",
    "gnu lesser general public license version 2 1": "LGPL-2.1",
    "gnu lesser general public license version 3": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0",
    "cc by 4 0": "CC-BY-4.0",
    "cc by sa 4 0": "CC-BY-SA-4.0",
    "cc by nc 4 0": "CC-BY-NC-4.0",
    "creative commons attribution 4 0 international license": "CC-BY-4.0",
    "creative commons attribution sharealike 4 0 international license": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4 0 international license": "CC-BY-NC-4.0",
    "unlicense": "Unlicense",
}
# SPDX identifiers, and the licences they name.
TAGS = {
    "MIT": "MIT",
    "ISC": "ISC",
    "0BSD": "0BSD",
    "Apache-2.0": "Apache-2.0",
    "BSD-2-Clause": "BSD-2-Clause",
    "BSD-3-Clause": "BSD-3-Clause",
    "MPL-2.0": "MPL-2.0",
    "GPL-2.0": "GPL-2.0",
    "GPL-2.0-only": "GPL-2.0",
    "GPL-2.0-or-later": "GPL-2.0",
    "GPL-3.0": "GPL-3.0",
    "GPL-3.0-only": "GPL-3.0",
    "GPL-3.0-or-later": "GPL-3.0",
    "LGPL-2.1-only": "LGPL-2.1",
    "LGPL-2.1-or-later": "LGPL-2.1",
    "LGPL-3.0-only": "LGPL-3.0",
    "LGPL-3.0-or-later": "LGPL-3.0",
    "AGPL-3.0-only": "AGPL-3.0",
    "AGPL-3.0-or-later": "AGPL-3.0",
    "CC0-1.0": "CC0-1.0",
    "CC-BY-4.0": "CC-BY-4.0",
    "CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "CC-BY-NC-4.0": "CC-BY-NC-4.0",
    "Unlicense": "Unlicense",
}
FIRST_NAME, FIRST_TAG = 101, 201
SENTENCES |= {i: f"licensed under the {name}" for i, name in enumerate(NAMES, FIRST_NAME)}
SENTENCES |= {
    i: "spdx license identifier " + re.sub("[^a-z0-9]+", " ", tag.lower()) for i, tag in enumerate(TAGS, FIRST_TAG)
}
# Rules by name, with the licence and the known sentences, in order.
RULES = {
    "mit_text": ("MIT", (4, 5, 6, 7)),
    "mit_text_joined": ("MIT", (3, 6, 7)),
    "isc_text": ("ISC", (51,)),
    "apache_header": ("Apache-2.0", (9, 10, 13, 14)),
    "apache_header_lines": ("Apache-2.0", (9, 11, 12, 13, 14)),
    "apache_header_start": ("Apache-2.0", (9,)),
    "gpl3_header": ("GPL-3.0", (17, 19, 20, 21)),
    "gpl3_header_start": ("GPL-3.0", (17,)),
    "gpl2_header": ("GPL-2.0", (18, 19, 20, 21)),
    "gpl2_header_start": ("GPL-2.0", (18,)),
    "lgpl21_header_start": ("LGPL-2.1", (55,)),
    "lgpl3_header_start": ("LGPL-3.0", (56,)),
    "agpl3_header_start": ("AGPL-3.0", (57,)),
    "mpl2_header": ("MPL-2.0", (53,)),
    "bsd2_text": ("BSD-2-Clause", (28, 29, 30)),
    "bsd3_text": ("BSD-3-Clause", (28, 29, 30, 31)),
    "unlicense": ("Unlicense", (32,)),
    "reserved": ("All-rights-reserved", (33,)),
}
RULES |= {f"mention_{i}": (license, (i,)) for i, license in enumerate(NAMES.values(), FIRST_NAME)}
RULES |= {f"tag_{i}": (license, (i,)) for i, license in enumerate(TAGS.values(), FIRST_TAG)}
#: Says nothing beside a licence that gives rights.
WEAK = "All-rights-reserved"
PERMISSIVE = (
    "0BSD",
    "Apache-2.0",
    "BSD-2-Clause",
    "BSD-3-Clause",
    "CC-BY-4.0",
    "CC0-1.0",
    "ISC",
    "MIT",
    "Unlicense",
)

MARK = "\x01"
#: Patterns, in turn, and what they become; an end of sentence becomes the mark. A line that begins
#: with a capitalised word begins a sentence, other line ends are wrapped text.
CUTS = (
    (r"(?i)(spdx-license-identifier:[^\n]*)", MARK + "$1" + MARK),
    (r"\n[^A-Za-z0-9\n]{0,8}([0-9]{1,2}|[A-Za-z]|[ivx]{2,4})[.)][\x20\x09]+", MARK),
    (r"[.!?]+([\x20\x09-\x0D]|$)", MARK + "$1"),
    (r"\n[\x20\x09]*\n", MARK),
    (r"\n([^A-Za-z0-9]{0,8}[A-Z][a-z])", MARK + "$1"),
    (r"[^A-Za-z0-9\x01]+", " "),
)
#: Of a sentence that holds ``under``, in turn: usual openings of a notice become one, and what
#: usually follows a licence's name is dropped.
NOTICE = "under"
NOTICES = (
    (
        r"^([a-z0-9]+ ){0,15}?(licensed|released|distributed|available|published|provided|covered) under "
        r"(the terms (and conditions )?of )?(the |a |an )?(terms (and conditions )?of )?(the |a |an )?",
        "licensed under the ",
    ),
    (
        r"^(licensed under the (" + "|".join(sorted(NAMES, key=lambda n: (-len(n), n))) + r")) "
        r"(see|which|as|and|or|you|for|in|unless|copyright|with) .*$",
        "$1",
    ),
)


def plain_sentence(text: str) -> str:
    """A known sentence as it is found: the notices' patterns for Python's own strings."""
    if NOTICE in text:
        for pattern, becomes in NOTICES:
            text = re.sub(pattern, becomes.replace("$1", r"\1"), text)
    return text


def sentences(text: Column) -> Column:
    """The sentences of a text in plain form: small letters and digits, single spaces."""
    plain = F.coalesce(text, F.lit(""))
    for pattern, becomes in CUTS:
        plain = F.regexp_replace(plain, pattern, becomes)
    return F.transform(F.filter(F.split(F.lower(plain), " ?\x01[ \x01]*"), lambda s: F.trim(s) != ""), noticed)


def noticed(sentence: Column) -> Column:
    found = F.trim(sentence)
    for pattern, becomes in NOTICES:
        found = F.regexp_replace(found, pattern, becomes)
    return F.when(F.contains(sentence, F.lit(NOTICE)), found).otherwise(F.trim(sentence))


def listed(ids: tuple[int, ...]) -> str:
    """Identifiers as text in which a pattern can skip some: each between commas of its own."""
    return "".join(f",{i}," for i in ids)


def pattern_of(ids: tuple[int, ...]) -> str:
    """What a list of identifiers is like that holds these in their order."""
    return "%" + "%".join(f",{i}," for i in ids) + "%"


def license_rules(docs: DataFrame, rules: dict = RULES, known: dict = SENTENCES, keep: list[str] | None = None) -> DataFrame:  # noqa: E501
    """Every row as struct ``row`` (the columns in ``keep``, or all), with the number of sentences,
    ``identifiers`` of the known ones in order, the ``rules`` that match, sorted, and their
    ``licenses``, each once, sorted.

    A rule matches if its identifiers follow each other among the known sentences of the text,
    whatever lies between. A rule that is part of a longer matching one is left out, and so is the
    one for reserved rights beside others. A null or empty text has no sentences, a text of any
    length is looked through whole; repeated rows are scanned each; an empty table gives an empty
    one. No rows are moved.
    """
    forms: dict[str, int] = {}
    for i, sentence in known.items():
        forms.setdefault(plain_sentence(sentence), i)
    number = F.create_map(*[F.lit(x) for s, i in forms.items() for x in (s, i)])
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(license).alias("license"),
                F.lit(listed(ids)).alias("ids"),
                F.lit(pattern_of(ids)).alias("pattern"),
            )
            for name, (license, ids) in sorted(rules.items())
        ]
    )
    rows = docs.select(whole_row(docs, keep), sentences(F.col("text")).alias("sentences"))
    found = rows.select(
        "row",
        F.size("sentences").cast("long").alias("n_sentences"),
        F.filter("sentences", lambda s: s.isin(list(forms))).alias("hits"),
    ).withColumn("identifiers", F.transform("hits", lambda s: F.element_at(number, s)))
    sequence = F.array_join(F.transform("identifiers", lambda i: F.concat(F.lit(","), i.cast("string"), F.lit(","))), "")
    matched = F.when(
        F.size("identifiers") > 0, F.filter(table, lambda r: _like(sequence, r))
    ).otherwise(F.filter(table, lambda r: F.lit(False)))
    found = found.withColumn("matched", matched)
    longer = lambda r, q: (q["ids"] != r["ids"]) & _like(q["ids"], r)
    part = lambda r: F.exists("matched", lambda q: longer(r, q))
    weak = lambda r: (r["license"] == WEAK) & F.exists("matched", lambda q: q["license"] != WEAK)
    found = found.withColumn("matched", F.filter("matched", lambda r: ~part(r) & ~weak(r)))
    return found.select(
        "row",
        "n_sentences",
        "identifiers",
        F.transform("matched", lambda r: r["rule"]).alias("rules"),
        F.array_sort(F.array_distinct(F.transform("matched", lambda r: r["license"]))).alias("licenses"),
    )


def _like(ids: Column, rule: Column) -> Column:
    return F.like(ids, rule["pattern"])


def permitted_rows(docs: DataFrame, allowed: tuple[str, ...] = PERMISSIVE) -> DataFrame:
    """The rows whose texts name no licence but those allowed, unchanged."""
    found = license_rules(docs)
    return found.filter(F.forall("licenses", lambda x: x.isin(*allowed))).select("row.*")
