"""Licence scans by sentences and ordered rules; DataFrame functions only."""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

# Sentences of licences as normalised by `normalised`, and the rules that
# sequences of them meet. Earlier rules come first and use up the sentences they match.
SENTENCES = {
    "mit-name": "mit license",
    "mit-the": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-name": "apache license version 2.0",
    "apache-licensed": "licensed under the apache license version 2.0",
    "apache-the": "licensed under the apache license version 2.0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl3-or-later": "either version 3 of the license or at your option any later version",
    "gpl2-or-later": "either version 2 of the license or at your option any later version",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v",
    "mit-title": "the mit license mit",
    "apache-title": "apache license version 2.0 january 2004 http www.apache.org licenses",
    "apache-terms": "terms and conditions for use reproduction and distribution",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2.1 february 1999",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "mpl2-title": "mozilla public license version 2.0",
    "cc-legal": "creative commons legal code",
    "cc0-title": "cc0 1.0 universal",
    "cc-by-nc": "licensed under cc by-nc 4.0",
    "cc-by-sa": "licensed under cc by-sa 4.0",
    "cc-by": "licensed under cc by 4.0",
    "cc0": "released under cc0 1.0 universal",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
    "bsd-endorse-names": "neither the name of the copyright holder nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-author": "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-advertise": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "apache-mean": "license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document",
    "apache-patent": "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non-exclusive no-charge royalty-free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
    "gpl3-copyleft": "the gnu general public license is a free copyleft license for software and other kinds of works",
    "gpl3-refers": "this license refers to version 3 of the gnu general public license",
    "gpl2-applies": "this license applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this general public license",
    "gpl2-freedom": "the licenses for most software are designed to take away your freedom to share and change it",
    "lgpl3-incorporates": "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below",
    "lgpl21-applies": "this license agreement applies to any software library or other program which contains a notice placed by the copyright holder or other authorized party saying it may be distributed under the terms of this lesser general public license also called this license",
    "agpl3-copyleft": "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software",
    "mpl2-grants": "each contributor hereby grants you a world-wide royalty-free non-exclusive license",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following",
    "zero-bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
}
RULES = [
    ("mit-full", "MIT", ["mit-the", "mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-full-short-name", "MIT", ["mit-name", "mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-title-text", "MIT", ["mit-title", "mit-grant", "mit-notice", "mit-as-is"]),
    ("isc-text", "ISC", ["isc-grant"]),
    ("bsd-3-clause", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("bsd-3-clause-names", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-names"]),
    ("bsd-3-clause-author", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-author"]),
    ("bsd-4-clause", "BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse"]),
    ("bsd-2-clause", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("apache-header", "Apache-2.0", ["apache-the", "apache-comply"]),
    ("apache-text", "Apache-2.0", ["apache-title", "apache-terms"]),
    ("gpl-3-or-later", "GPL-3.0-or-later", ["gpl-redistribute", "gpl3-or-later"]),
    ("gpl-2-or-later", "GPL-2.0-or-later", ["gpl-redistribute", "gpl2-or-later"]),
    ("gpl-3-text", "GPL-3.0-only", ["gpl3-title"]),
    ("gpl-2-text", "GPL-2.0-only", ["gpl2-title"]),
    ("lgpl-3-text", "LGPL-3.0-only", ["lgpl3-title"]),
    ("lgpl-2.1-text", "LGPL-2.1-only", ["lgpl21-title"]),
    ("agpl-3-text", "AGPL-3.0-only", ["agpl3-title"]),
    ("mpl-2-text", "MPL-2.0", ["mpl2-title"]),
    ("cc0-text", "CC0-1.0", ["cc-legal", "cc0-title"]),
    ("mit-released", "MIT", ["mit-released"]),
    ("mit-licensed", "MIT", ["mit-licensed"]),
    ("mit-grant", "MIT", ["mit-grant"]),
    ("mit-name", "MIT", ["mit-name"]),
    ("mit-the", "MIT", ["mit-the"]),
    ("apache-licensed", "Apache-2.0", ["apache-licensed"]),
    ("apache-the", "Apache-2.0", ["apache-the"]),
    ("apache-name", "Apache-2.0", ["apache-name"]),
    ("gpl-3-work", "GPL-3.0-only", ["gpl3-work"]),
    ("mpl-2", "MPL-2.0", ["mpl2"]),
    ("cc-by-nc", "CC-BY-NC-4.0", ["cc-by-nc"]),
    ("cc-by-sa", "CC-BY-SA-4.0", ["cc-by-sa"]),
    ("cc-by", "CC-BY-4.0", ["cc-by"]),
    ("cc0", "CC0-1.0", ["cc0"]),
    ("unlicense", "Unlicense", ["unlicense"]),
    ("reserved", "LicenseRef-all-rights-reserved", ["reserved"]),
    ("apache-text-body", "Apache-2.0", ["apache-mean"]),
    ("apache-text-grant", "Apache-2.0", ["apache-patent"]),
    ("gpl-3-text-body", "GPL-3.0-only", ["gpl3-copyleft"]),
    ("gpl-3-text-refers", "GPL-3.0-only", ["gpl3-refers"]),
    ("gpl-2-text-body", "GPL-2.0-only", ["gpl2-applies"]),
    ("gpl-2-text-freedom", "GPL-2.0-only", ["gpl2-freedom"]),
    ("lgpl-3-text-body", "LGPL-3.0-only", ["lgpl3-incorporates"]),
    ("lgpl-2.1-text-body", "LGPL-2.1-only", ["lgpl21-applies"]),
    ("agpl-3-text-body", "AGPL-3.0-only", ["agpl3-copyleft"]),
    ("mpl-2-text-body", "MPL-2.0", ["mpl2-grants"]),
    ("zlib-text", "Zlib", ["zlib-grant"]),
    ("boost-text", "BSL-1.0", ["boost-grant"]),
    ("0bsd-text", "0BSD", ["zero-bsd-grant"]),
]
# The parts of which notices are made up.
GNU = [("gpl", "general", "GPL", ["2", "3"]), ("lgpl", "lesser general", "LGPL", ["2.1", "3"]), ("agpl", "affero general", "AGPL", ["3"])]
NAMES = {
    "MIT": ["the mit license", "mit license", "the mit licence", "the terms of the mit license", "an mit license", "the mit license mit"],
    "ISC": ["the isc license", "isc license"],
    "BSD-2-Clause": ["the bsd 2-clause license", "the 2-clause bsd license", "the simplified bsd license"],
    "BSD-3-Clause": ["the bsd 3-clause license", "the 3-clause bsd license", "the new bsd license", "the modified bsd license"],
    "Apache-2.0": ["the apache license version 2.0", "the apache license 2.0", "apache license 2.0", "the apache 2.0 license", "apache 2.0"],
    "MPL-2.0": ["the mozilla public license version 2.0", "the mozilla public license 2.0", "mpl 2.0"],
    "GPL-2.0-only": ["the gnu general public license version 2", "the gnu gpl version 2", "the gnu general public license v2.0", "gpl v2"],
    "GPL-3.0-only": ["the gnu general public license version 3", "the gnu gpl version 3", "the gnu general public license v3.0", "gpl v3"],
    "LGPL-3.0-only": ["the gnu lesser general public license version 3", "the gnu lgpl version 3"],
    "AGPL-3.0-only": ["the gnu affero general public license version 3", "the gnu agpl version 3"],
    "CC0-1.0": ["cc0 1.0 universal", "cc0 1.0", "the cc0 1.0 universal public domain dedication"],
}
NAMES |= {
    "BSL-1.0": ["the boost software license version 1.0", "the boost software license", "boost software license 1.0"],
    "EPL-1.0": ["the eclipse public license version 1.0", "the eclipse public license 1.0", "the eclipse public license v1.0"],
    "EPL-2.0": ["the eclipse public license version 2.0", "the eclipse public license 2.0", "the eclipse public license v2.0"],
    "Zlib": ["the zlib license", "zlib license"],
    "Artistic-2.0": ["the artistic license 2.0", "the artistic license version 2.0"],
    "CDDL-1.0": ["the common development and distribution license version 1.0", "the cddl 1.0 license"],
    "EUPL-1.2": ["the european union public licence version 1.2", "the eupl 1.2 license"],
    "OFL-1.1": ["the sil open font license version 1.1", "the sil open font license 1.1"],
    "Unlicense": ["the unlicense"],
    "WTFPL": ["the wtfpl license"],
    "LGPL-2.1-only": ["the gnu lesser general public license version 2.1", "the gnu lgpl version 2.1", "lgpl v2.1"],
    "0BSD": ["the bsd zero clause license"],
}
CC = {"by": "attribution", "by-sa": "attribution-sharealike", "by-nc": "attribution-noncommercial", "by-nc-sa": "attribution-noncommercial-sharealike", "by-nd": "attribution-noderivatives", "by-nc-nd": "attribution-noncommercial-noderivatives"}
PORTS = {"2.0": "generic", "2.5": "generic", "3.0": "unported", "4.0": "international"}
for (_k, _name), (_v, _port) in product(CC.items(), PORTS.items()):
    NAMES[f"CC-{_k.upper()}-{_v}"] = [f"{c} {_v}{p}{e}" for c in (f"cc {_k}", f"cc-{_k}", f"creative commons {_name}") for p in ("", f" {_port}") for e in ("", " license")]
#: Identifiers as tags and package files state them, beside those of ``NAMES``.
TAGS = ["MIT-0", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-1.1", "Python-2.0", "PostgreSQL", "MS-PL", "AFL-3.0", "BSD-4-Clause", "X11", "NCSA", "CC-PDDC"]
#: Choices between two licences that tags often state.
CHOICES = [("MIT", "Apache-2.0"), ("Apache-2.0", "MIT"), ("MIT", "BSD-3-Clause"), ("BSD-3-Clause", "MIT"), ("GPL-2.0-only", "MIT"), ("MIT", "GPL-2.0-only"), ("Apache-2.0", "BSD-2-Clause"), ("EPL-2.0", "Apache-2.0"), ("GPL-2.0-only", "BSD-3-Clause")]
VERBS = ["licensed under ", "released under ", "distributed under ", "available under ", "provided under "]
#: One of these is in every known sentence, so a text or sentence with none of them holds none.
WORDS = ["licen", "software", "redistribut", "reserved", "creativecommons", "cc0", "gpl", "apache", "for use reproduction", "creative commons", "and conditions"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What may come before the part of a notice that counts, in it, and after it.
NOTICE = "^(?:(?:this|the) (?:project|software|work|code|source code|library|program|package|repository|module|file) is (?:also )?)?(licensed|released|distributed|available|provided) under (?:the terms (?:and conditions )?of )?(?:an |a |the )?"
SEE = "^(.+?) (?:-+ )?(?:please )?see (?:the )?(?:license|licence|copying)(?: .*)?$"


def _short(sentence: str) -> str:
    """What :func:`normalised` leaves of a known sentence."""
    return re.sub(NOTICE, r"\1 under ", sentence)


def _built() -> tuple[list[tuple[str, str]], list[tuple[str, str, list[str]]]]:
    """Known sentences (id, sentence) and rules: those above and those made up of parts."""
    known, rules = {_short(text): i for i, text in SENTENCES.items()}, list(RULES)

    def add(name: str, licence: str, texts: list[str], before: bool = False) -> None:
        if new := [t for t in dict.fromkeys(map(_short, texts)) if t not in known]:
            known.update(dict.fromkeys(new, name))
            rules.insert(0 if before else len(rules), (name, licence, [name]))

    for short, kind, spdx, versions in GNU:
        terms = f"it under the terms of the gnu {kind} public license"
        for v in versions:
            number = v if "." in v else f"{v}.0"
            leads = [f"{x}you can redistribute it and or modify {terms}" for x in ("", "this program is free software ")]
            free = "as published by the free software foundation"
            add(f"{short}-{v}-notice", f"{spdx}-{number}-or-later", [f"{x} {free} either version {v} of the license or at your option any later version" for x in leads], before=True)
            add(f"{short}-{v}-only-notice", f"{spdx}-{number}-only", [t for x in leads for t in (f"{x} version {v} {free}", f"{x} {free} version {v} of the license")], before=True)
    for licence, names in NAMES.items():
        low = licence.lower()
        said = [v + n for v in VERBS for n in names] + [f"license {n}" for n in names]
        add(f"said-{low}", licence, [t for t in said if any(w in t for w in WORDS)] + [f"{low} licensed"])
    for licence in [*NAMES, *TAGS]:
        low = licence.lower()
        add(f"tag-{low}", licence, [f"{tag} {low}" for tag in ("spdx-license-identifier", "license", "licence")] + [f"{low.removesuffix('-only')} license"])
    for one, other in CHOICES:
        low = f"{one} or {other}".lower()
        add(f"tag-{low.replace(' ', '-')}", f"{min(one, other)} OR {max(one, other)}", [f"{tag} {x}" for tag in ("spdx-license-identifier", "license", "licence") for x in (low, low.replace("-only", ""))])
    for kind, version in product(CC, PORTS):
        at = f"creativecommons.org licenses {kind} {version}"
        leads = ["", "http ", "https ", *[f"to view a copy of this license visit {x}" for x in ("", "http ", "https ")]]
        add(f"url-cc-{kind}-{version}", f"CC-{kind.upper()}-{version}", [x + at + end for x in leads for end in ("", " legalcode", " deed.en")])
    add("url-cc0-1.0", "CC0-1.0", [f"{x}creativecommons.org publicdomain zero 1.0{end}" for x in ("", "http ", "https ") for end in ("", " legalcode")])
    return [(i, text) for text, i in known.items()], rules


KNOWN, ALL_RULES = _built()

#: What may stand before the words of a line: marks of comments, quotations and lists.
LEADERS = r"\n[ \t\r]*(?:/[*]+|[*]+/|[*]+|//+|#+|;+|--+|>+|%+)?[ \t\r]*"
END = "\x01"


def _either(words: str) -> str:
    """A pattern of words in either case, with any white space between."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else r"[ \t\r\n]+" for c in words)


#: Targets of links; tags before an identifier; the clause on endorsement, whose owner may be an ``Inc.``
LINK = r"\]\([^)\n]*\)"
TAG = f"({_either('identifier')}|{_either('licen')}[CcSs][Ee])[*_\"']*[ \\t]*:[*_\"']*[ \\t]+"
ENDORSE = f"{_either('neither the name')}[Ss]?[ \\t\\r\\n]+[Oo][Ff][ \\t\\r\\n](?s:.{{1,200}}?)[ \\t\\r\\n]{_either('nor the name')}[Ss]?[ \\t\\r\\n]+[Oo][Ff][ \\t\\r\\n]"
OWNED = "Neither the name of the copyright holder nor the names of "


def hinted(text: Column) -> Column:
    """Whether a text may hold a known sentence: one of ``WORDS``, whatever its case, its words parted by any one mark."""
    low = F.translate(text, UPPER, LOWER)
    out = F.lit(False)
    for w in WORDS:
        out |= F.contains(low, F.lit(w)) if " " not in w else F.contains(low, F.lit(w.split()[-1]))
    return out


def sentences(text: Column) -> Column:
    """Parts of a text: a sentence ends at a blank line, and at ``.``, ``;``, ``:``, ``!`` or ``?`` before white space.

    Targets of links go, as does the colon between ``License`` and an identifier; an owner's
    name in the clause on endorsement, full stops and all, becomes that of the standard text.
    """
    bare = F.regexp_replace(F.concat(F.lit("\n"), text), LEADERS, "\n")
    bare = F.when(F.contains(bare, F.lit("](")), F.regexp_replace(bare, LINK, "]")).otherwise(bare)
    bare = F.regexp_replace(F.regexp_replace(bare, TAG, "$1 "), ENDORSE, OWNED)
    cut = F.regexp_replace(bare, "\n\n+|([.;:!?])[ \\t\\r\n]+", "$1" + END)
    return F.split(cut, END)


def normalised(sentence: Column) -> Column:
    """Lower-case words of ASCII letters, digits, ``.``, ``+`` and ``-`` with one space between, without marks at the end.

    A number or letter before a bracket, as lists have, goes, as do the subject of a notice,
    articles and terms before a licence's name, and the hint to see its file.
    """
    bare = F.translate(sentence, UPPER, LOWER)
    listed = F.when(F.contains(bare, F.lit(")")), F.regexp_replace(bare, r"^[ \n(]*[0-9a-z]{1,2}[)][ \n\t]+", "")).otherwise(bare)
    words = F.btrim(F.regexp_replace(listed, "[^a-z0-9.+-]+", " "), F.lit(" .-"))
    words = F.when(F.contains(words, F.lit(" under ")), F.regexp_replace(words, NOTICE, "$1 under ")).otherwise(words)
    return F.when(F.contains(words, F.lit(" see ")), F.btrim(F.regexp_replace(words, SEE, "$1"), F.lit(" .-"))).otherwise(words)


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, version (digest of the text), pos, sentence_id of every known sentence.

    A sentence may run over several lines; each of its lines counts as one too, as headings
    and short notices end without a mark.
    """
    known = docs.sparkSession.createDataFrame(KNOWN, "sentence_id string, sentence string")
    rows = pick(docs, id_col, text_col).toDF("id", "text").withColumn("text", F.coalesce("text", F.lit(""))).where(hinted(F.col("text")))
    cut = rows.select("id", F.unhex(F.md5("text")).alias("version"), F.posexplode(sentences(F.col("text"))).alias("s", "sentence")).withColumn("sentence", F.btrim("sentence", F.lit("\n")))
    lines = F.split("sentence", "\n")
    parts = F.when(F.instr("sentence", "\n") > 0, F.concat(F.array("sentence"), lines)).otherwise(F.array("sentence"))
    cut = cut.where(hinted(F.col("sentence"))).select("id", "version", "s", F.posexplode(parts).alias("l", "sentence")).withColumn("sentence", normalised(F.col("sentence")))
    return cut.join(F.broadcast(known), "sentence").select("id", "version", F.struct("s", "l").alias("pos"), "sentence_id")


def matched(sequence: Column) -> Column:
    """Rules, in their order, that a sequence of sentences like ``<a><b>`` meets: array of (rule, licence, times)."""
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(x).alias("licence"), F.lit("".join(f"<{s}>" for s in ids)).alias("ids")) for r, x, ids in ALL_RULES])
    found = "array<struct<rule:string,licence:string,times:bigint>>"
    start = F.struct(sequence.alias("left"), F.array().cast(found).alias("found"))

    def meet(done: Column, rule: Column) -> Column:
        times = ((F.length(done["left"]) - F.length(F.replace(done["left"], rule["ids"], F.lit("")))) / F.length(rule["ids"])).cast("bigint")
        hit = F.array(F.struct(rule["rule"].alias("rule"), rule["licence"].alias("licence"), times.alias("times")))
        return F.struct(F.replace(done["left"], rule["ids"], F.lit("|")).alias("left"), F.when(times > 0, F.concat(done["found"], hit)).otherwise(done["found"]).alias("found"))

    return F.aggregate(rules, start, meet)["found"]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, n_sentences (known ones), rules, licences, both comma-joined.

    Every whole text is cut into sentences; those known, by a join with a fixed table, give
    a sequence of identifiers, against which the ordered rules are matched. Rules stand in
    their order, licences sorted. A null text counts as empty; a text without known
    sentences has 0 and empty strings. Rows that repeat are each returned; other columns,
    whatever their names, are left out; an empty table gives no rows.
    """
    met = recognised(docs, id_col, text_col).groupBy("id", "version").agg(F.sort_array(F.collect_set(F.struct("pos", "sentence_id"))).alias("seen"))
    met = met.withColumn("found", matched(F.concat_ws("", F.transform("seen", lambda s: F.concat(F.lit("<"), s["sentence_id"], F.lit(">"))))))
    met = met.select(
        F.col("id").alias("met_id"), F.col("version").alias("met_version"), F.size("seen").cast("long").alias("n"),
        F.array_join(F.transform("found", lambda r: r["rule"]), ",").alias("rules"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda r: r["licence"]))), ",").alias("licences"),
    )
    rows = pick(docs, id_col, text_col).toDF("id", "text").select("id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("version"))
    both = rows.join(met, rows["id"].eqNullSafe(met["met_id"]) & (rows["version"] == met["met_version"]), "left")
    return both.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_sentences"), F.coalesce("rules", F.lit("")).alias("rules"), F.coalesce("licences", F.lit("")).alias("licences"))


def oracle() -> str:
    """The same in SQL for DuckDB; the rules are one step each."""
    known = ", ".join(f"('{k}', '{s}')" for k, s in KNOWN)
    quoted = TAG.replace("'", "''")
    sql = rf"""
        WITH known(sentence_id, sentence) AS (VALUES {known}),
        bare AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(chr(10) || coalesce(text, ''), '{LEADERS}', chr(10), 'g'), '{LINK}', ']', 'g'), '{quoted}', '\1 ', 'g'), '{ENDORSE}', '{OWNED}', 'g') AS t FROM documents),
        cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(t, '\n\n+', chr(1), 'g'), '([.;:!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM bare),
        parts AS (SELECT doc_id, trim(unnest(parts), chr(10)) AS part, unnest(range(len(parts))) AS s FROM cut),
        lines AS (SELECT doc_id, s, unnest(ps) AS part, unnest(range(len(ps))) AS l
                  FROM (SELECT doc_id, s, CASE WHEN contains(part, chr(10)) THEN list_concat([part], string_split(part, chr(10))) ELSE [part] END AS ps FROM parts)),
        low AS (SELECT doc_id, s, l, regexp_replace(translate(part, '{UPPER}', '{LOWER}'), '^[ \n(]*[0-9a-z]{{1,2}}[)][ \n\t]+', '') AS part FROM lines),
        plain AS (SELECT doc_id, s, l, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(part, '[^a-z0-9.+-]+', ' ', 'g'), '^[ .-]+|[ .-]+$', '', 'g'),
                  '{NOTICE}', '\1 under '), '{SEE}', '\1'), '[ .-]+$', '') AS sentence FROM low),
        s0 AS (SELECT doc_id, count(*) AS n, string_agg('<' || sentence_id || '>', '' ORDER BY s, l) AS seq, []::VARCHAR[] AS rules, []::VARCHAR[] AS licences
               FROM plain JOIN known USING (sentence) GROUP BY doc_id)"""
    for i, (rule, licence, ids) in enumerate(ALL_RULES):
        own = "".join(f"<{s}>" for s in ids)
        sql += f""",
        s{i + 1} AS (SELECT doc_id, n, replace(seq, '{own}', '|') AS seq,
               CASE WHEN contains(seq, '{own}') THEN list_append(rules, '{rule}') ELSE rules END AS rules,
               CASE WHEN contains(seq, '{own}') THEN list_append(licences, '{licence}') ELSE licences END AS licences FROM s{i})"""
    return sql + f"""
        SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(array_to_string(rules, ','), '') AS rules,
               coalesce(array_to_string(list_sort(list_distinct(licences)), ','), '') AS licences
        FROM documents d LEFT JOIN s{len(ALL_RULES)} USING (doc_id)"""
