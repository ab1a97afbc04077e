"""Licence scans by ordered signature rules, in DataFrame functions only.

A text is reduced to its words, joined by single blanks. Each rule is a regular expression over that text behind a keyword:
a rule runs only where its keyword stands, and no rule runs where none of the root words stands. Where detections overlap,
one that lies inside another of the same or a better rank is suppressed, so "gnu lesser general public licence" is not also
a plain "general public licence". Base phrases are reported always.

Defined results. Null and empty texts have no words, no labels and score 0. Letters other than A-Z keep their case. Repeated
rows are scanned alike; an empty table gives an empty table. Of detections with equal bounds and rank the one named first in
``SIGNATURES`` stays. Detections of a document are ordered by start, then by the longer one: n log n in their number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import whole_text
from tessera.llm.quality import let

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: A text without any of these root words holds no signature.
ROOTS = (
    "licen", "copyright", "copyleft", "rights reserved", "cc by", "cc0", "cc zero", "public domain", "creative commons",
    "creativecommons", "general public", "gpl", "gfdl", "mpl", "epl", "cddl", "eupl", "wtfpl", "odbl", "cdla", "sspl", "eula",
    "ms pl", "apache 2", "apache version 2", "apache v 2", "clause bsd", "bsd 2", "bsd 3", "bsd 4", "0bsd", "0 bsd",
    "mit no attribution", "warrant", "permission", "redistribution", "redistribute", "spdx", "merchantability", "trademark",
    "proprietary and", "and proprietary", "deal in the software", "provided as is", "neither the name", "free software foundation",
    "same terms as perl", "commons clause", "open data commons", "community data", "openrail", "good not evil", "be reproduced",
    "unauthorized", "commercial use", "commercial purposes", "personal use only", "purposes only", "use only", "educational use",
    "educational purposes", "terms of use", "terms of service", "royalty free", "fitness for a", "patent grant", "released under",
    "rights are reserved", "cecill",
)

#: Rank | keyword | label | regular expression over blank-joined words. Rank 1: the name of a licence with its version or a
#: whole clause; 2: the name alone; 3: a hint. The keyword stands in all that the expression matches. ``#`` stands for ``(?: version| v)?``, ``L`` for ``licen[cs]e``.
SIGNATURES = r"""
1|apache|apache-2.0|apache L# 2(?: 0)?
1|apache|apache-2.0|apache# 2(?: 0)? L
1|apache|apache-1.1|apache(?: software)? L# 1 1
1|apache|apache-1.0|apache(?: software)? L# 1 0
1|apache|apache-2.0|www apache org licenses license 2 0(?: txt| html)?
1|apache|apache-2.0|spdx license identifier apache 2 0
2|apache|apache|apache(?: software)? L
3|apache|apache|apache licen[cs]ed
1|mit|mit|(?:under|with) the mit L
1|mit|mit|spdx license identifier mit
1|mit|mit-0|mit no attribution
1|mit|mit-0|mit 0 L
2|mit|mit|mit L
2|mit|mit|mit x11 L
2|expat|mit|expat L
1|x11|x11|x11 L
1|permission is hereby|mit|permission is hereby granted free of charge to any person obtaining a copy
2|deal in the software|mit|deal in the software without restriction
3|software is provided|as-is|software is provided as is without warranty of any kind
1|isc|isc|isc L
1|isc|isc|spdx license identifier isc
1|permission to use copy|isc|permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee
2|bsd|bsd|bsd(?: style)? L
1|bsd|bsd-2-clause|bsd 2 clause(?: simplified)?(?: L)?
1|bsd|bsd-2-clause|2 clause bsd(?: L)?
1|bsd|bsd-2-clause|simplified bsd L
1|bsd|bsd-2-clause|freebsd L
1|bsd|bsd-3-clause|bsd 3 clause(?: new| revised)?(?: L)?
1|bsd|bsd-3-clause|3 clause bsd(?: L)?
1|bsd|bsd-3-clause|(?:new|revised|modified) bsd L
1|bsd|bsd-4-clause|bsd 4 clause(?: L)?
1|bsd|bsd-4-clause|original bsd L
1|bsd|0bsd|0 ?bsd(?: L)?
1|bsd|0bsd|zero clause bsd(?: L)?
1|redistribution and use|bsd|redistribution and use in source and binary forms with or without modification
2|neither the name|bsd-3-clause|neither the name of .{1,80}? nor the names of its contributors
3|redistributions of source|bsd|redistributions of source code must retain
3|redistributions in binary|bsd|redistributions in binary form must reproduce
1|general public|gpl-2.0|(?:gnu )?general public L# 2(?: 0)?
1|general public|gpl-3.0|(?:gnu )?general public L# 3(?: 0)?
1|general public|gpl-1.0|(?:gnu )?general public L# 1(?: 0)?
1|general public|gpl-2.0-or-later|general public L as published by the free software foundation either version 2 of the L or .{0,20}any later version
1|general public|gpl-3.0-or-later|general public L as published by the free software foundation either version 3 of the L or .{0,20}any later version
1|general public|gpl-2.0-or-later|general public L# 2(?: 0)? or(?: at your option)?(?: any)? later
1|general public|gpl-3.0-or-later|general public L# 3(?: 0)? or(?: at your option)?(?: any)? later
2|general public|gpl|gnu general public L
3|general public|gpl|general public L
1|lesser general|lgpl-2.1|(?:gnu )?lesser general public L# 2 1
1|lesser general|lgpl-3.0|(?:gnu )?lesser general public L# 3(?: 0)?
2|lesser general|lgpl|(?:gnu )?lesser general public L
1|library general|lgpl-2.0|(?:gnu )?library general public L# 2(?: 0)?
2|library general|lgpl|(?:gnu )?library general public L
1|affero|agpl-3.0|(?:gnu )?affero general public L# 3(?: 0)?
1|affero|agpl-1.0|affero general public L# 1(?: 0)?
2|affero|agpl|(?:gnu )?affero general public L
1|gpl|gpl-2.0|gpl ?v?# ?2(?: 0)?(?: only)?
1|gpl|gpl-3.0|gpl ?v?# ?3(?: 0)?(?: only)?
1|gpl|gpl-2.0-or-later|gpl ?v?# ?2(?: 0)? or later
1|gpl|gpl-3.0-or-later|gpl ?v?# ?3(?: 0)? or later
1|lgpl|lgpl-2.1|lgpl ?v?# ?2 1(?: only)?
1|lgpl|lgpl-2.1-or-later|lgpl ?v?# ?2 1 or later
1|lgpl|lgpl-3.0|lgpl ?v?# ?3(?: 0)?(?: only)?
1|lgpl|lgpl-3.0-or-later|lgpl ?v?# ?3(?: 0)? or later
1|agpl|agpl-3.0|agpl ?v?# ?3(?: 0)?(?: only)?
1|agpl|agpl-3.0-or-later|agpl ?v?# ?3(?: 0)? or later
2|gpl|gpl|(?:gnu )?gpl
2|lgpl|lgpl|(?:gnu )?lgpl
2|agpl|agpl|(?:gnu )?agpl
1|gpl|gpl-classpath|gpl with(?: the)? classpath exception
1|linking exception|gpl-linking|gpl with .{0,30}linking exception
1|free documentation|gfdl-1.1|(?:gnu )?free documentation L# 1 1
1|free documentation|gfdl-1.2|(?:gnu )?free documentation L# 1 2
1|free documentation|gfdl-1.3|(?:gnu )?free documentation L# 1 3
2|free documentation|gfdl|(?:gnu )?free documentation L
2|gfdl|gfdl|gfdl
3|free software foundation|fsf|free software foundation
3|copyleft|copyleft|copyleft
1|mozilla|mpl-1.0|mozilla public L# 1 0
1|mozilla|mpl-1.1|mozilla public L# 1 1
1|mozilla|mpl-2.0|mozilla public L# 2(?: 0)?
2|mozilla|mpl|mozilla public L
1|mpl|mpl-1.1|mpl ?v?# ?1 1
1|mpl|mpl-2.0|mpl ?v?# ?2 0
1|eclipse|epl-1.0|eclipse public L# 1(?: 0)?
1|eclipse|epl-2.0|eclipse public L# 2(?: 0)?
2|eclipse|epl|eclipse public L
1|eclipse distribution|edl-1.0|eclipse distribution L# 1 0
1|epl|epl-1.0|epl ?v?# ?1 0
1|epl|epl-2.0|epl ?v?# ?2 0
1|common development|cddl-1.0|common development and distribution L# 1 0
1|common development|cddl-1.1|common development and distribution L# 1 1
2|common development|cddl|common development and distribution L
2|cddl|cddl|cddl
1|common public|cpl-1.0|common public L# 1 0
2|common public|cpl|common public L
1|common public attribution|cpal-1.0|common public attribution L
1|boost|bsl-1.0|boost software L# 1 0
2|boost|bsl-1.0|boost software L
1|zlib|zlib|zlib(?: libpng)? L
2|zlib|zlib|spdx license identifier zlib
1|artistic|artistic-1.0|artistic L# 1 0
1|artistic|artistic-2.0|artistic L# 2 0
2|artistic|artistic|artistic L
1|european union|eupl-1.1|european union public L# 1 1
1|european union|eupl-1.2|european union public L# 1 2
2|european union|eupl|european union public L
2|eupl|eupl|eupl
1|unlicense|unlicense|(?:the )?unlicense
2|unencumbered|unlicense|free and unencumbered software released into the public domain
1|do what the f|wtfpl|do what the f\S* you want to public L
2|wtfpl|wtfpl|wtfpl
1|open software|osl-1.0|open software L# 1 0
1|open software|osl-2.1|open software L# 2 1
1|open software|osl-3.0|open software L# 3 0
2|open software|osl|open software L
1|academic free|afl-2.1|academic free L# 2 1
1|academic free|afl-3.0|academic free L# 3 0
2|academic free|afl|academic free L
1|python software|psf-2.0|python software foundation L(?: version 2)?
2|psf|psf-2.0|psf L
2|php|php-3.01|php L(?: version 3 01)?
2|ruby|ruby|ruby s? ?L
2|openssl|openssl|openssl L
2|openldap|oldap|openldap public L
2|postgresql|postgresql|postgresql L
2|vim|vim|vim L
2|perl|perl|same terms as perl(?: itself)?
1|sil open|ofl-1.0|sil open font L# 1 0
1|sil open|ofl-1.1|sil open font L# 1 1
2|open font|ofl|(?:sil )?open font L
2|microsoft public|ms-pl|microsoft public L
2|microsoft reciprocal|ms-rl|microsoft reciprocal L
2|ms pl|ms-pl|ms pl
2|apple public|apsl|apple public source L
2|ibm public|ipl-1.0|ibm public L
2|sun public|spl-1.0|sun public L
2|netscape public|npl|netscape public L
2|q public|qpl|q public L
2|sleepycat|sleepycat|sleepycat L
2|server side public|sspl-1.0|server side public L
2|sspl|sspl-1.0|sspl
2|business source|busl-1.1|business source L
2|elastic|elastic-2.0|elastic L(?: 2 0)?
2|commons clause|commons-clause|commons clause
2|mulan|mulanpsl|mulan permissive software L
2|cecill|cecill|cecill(?: [abc])?(?: L)?
2|beerware|beerware|beerware L
2|fair L|fair|fair L
2|json|json|json L
1|good not evil|json|shall be used for good not evil
2|open data commons|odc|open data commons
1|open database|odbl-1.0|(?:odc )?open database L(?: 1 0)?
2|odbl|odbl-1.0|odbl
1|attribution L|odc-by|open data commons attribution L
1|public domain dedication|pddl|public domain dedication and L
2|community data|cdla|community data L agreement
1|cdla|cdla-permissive|cdla permissive
1|cdla|cdla-sharing|cdla sharing
2|open government|ogl|open government L
1|open government|ogl-3.0|open government L# 3 0
2|llama|llama-community|llama(?: \S+)? community L
2|openrail|openrail|(?:creativeml )?openrail(?: m)?
2|responsible ai|rail|responsible ai L
1|cc0|cc0-1.0|cc0(?: 1 0)?(?: universal)?
2|cc zero|cc0-1.0|cc zero
2|creative commons zero|cc0-1.0|creative commons zero
1|cc by|cc-by-nc-nd|cc by nc nd(?: [1-4] [05])?
1|cc by|cc-by-nc-sa|cc by nc sa(?: [1-4] [05])?
1|cc by|cc-by-nc|cc by nc(?: [1-4] [05])?
1|cc by|cc-by-nd|cc by nd(?: [1-4] [05])?
1|cc by|cc-by-sa|cc by sa(?: [1-4] [05])?
1|cc by|cc-by-1.0|cc by 1 0
1|cc by|cc-by-2.0|cc by 2 0
1|cc by|cc-by-2.5|cc by 2 5
1|cc by|cc-by-3.0|cc by 3 0
1|cc by|cc-by-4.0|cc by 4 0
1|cc by|cc-by-sa-3.0|cc by sa 3 0
1|cc by|cc-by-sa-4.0|cc by sa 4 0
1|cc by|cc-by-nc-4.0|cc by nc 4 0
1|cc by|cc-by-nc-3.0|cc by nc 3 0
1|cc by|cc-by-nd-4.0|cc by nd 4 0
1|cc by|cc-by-nc-sa-4.0|cc by nc sa 4 0
1|cc by|cc-by-nc-nd-4.0|cc by nc nd 4 0
2|creative commons attribution|cc-by|creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: L)?
1|attribution non|cc-by-nc|creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: L)?
1|commercial share|cc-by-nc-sa|creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: L)?
1|commercial no|cc-by-nc-nd|creative commons attribution non ?commercial no ?deriv\S*(?: [1-4] [05])?(?: international| unported)?(?: L)?
1|share|cc-by-sa|creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: L)?
1|deriv|cc-by-nd|creative commons attribution no ?deriv\S*(?: [1-4] [05])?(?: international| unported)?(?: L)?
1|creativecommons|cc-by|creativecommons org licenses by [1-4] [05]
1|creativecommons|cc-by-sa|creativecommons org licenses by sa [1-4] [05]
1|creativecommons|cc-by-nc|creativecommons org licenses by nc [1-4] [05]
1|creativecommons|cc-by-nd|creativecommons org licenses by nd [1-4] [05]
1|creativecommons|cc-by-nc-sa|creativecommons org licenses by nc sa [1-4] [05]
1|creativecommons|cc-by-nc-nd|creativecommons org licenses by nc nd [1-4] [05]
1|creativecommons|cc0-1.0|creativecommons org publicdomain zero 1 0
3|creative commons|creative-commons|creative commons(?: L)?
2|public domain|public-domain|(?:in|into|to) the public domain
2|public domain|public-domain|public domain dedication
3|public domain|public-domain|public domain
2|all rights|reserved|all rights (?:are )?reserved
2|rights reserved|some-rights|some rights reserved
1|rights reserved|public-domain|no rights reserved
2|may not be|reserved|may not be (?:reproduced|copied|distributed) .{0,60}without .{0,30}permission
2|reproduc|reserved|no part of this .{1,40}? may be reproduced
2|proprietary|proprietary|proprietary and confidential
2|confidential|proprietary|confidential and proprietary
3|proprietary|proprietary|proprietary L
2|trademark|trademark|(?:registered )?trademarks? of
2|unauthorized|reserved|unauthorized (?:copying|reproduction|distribution|use) .{0,60}prohibited
3|copyright|copyright|copyright(?: c)? (?:19|20)\d\d
3|copyright|copyright|copyright by
3|copyright notice|notice|above copyright notice
2|for non|non-commercial|for non ?commercial (?:use|purposes)(?: only)?
2|personal use|personal-use|for personal use only
2|for academic|research-only|for academic(?: and \S+)? (?:use|purposes) only
2|for research|research-only|for research(?: and \S+)? (?:use|purposes) only
2|educational|educational|for educational (?:use|purposes)(?: only)?
2|terms of|terms|terms of (?:use|service)
2|end user|eula|end user L agreement
2|eula|eula|eula
2|shareware|shareware|shareware L
2|freeware|freeware|freeware L
2|royalty free|royalty-free|royalty free(?: L)?
3|redistribut|redistribution|free to redistribute
3|merchantability|warranty|warrant(?:y|ies) of merchantability
3|fitness for|warranty|fitness for a particular purpose
3|warranty|warranty|without (?:any )?warranty
3|patent|patent|patent (?:grant|L)
3|spdx|spdx|spdx license identifier
3|ed under|licensed|(?:dual )?licen[cs]ed under(?: the terms of)?
3|released under|licensed|released under
3|permission|permission|with (?:kind )?permission of
3|licen|licensed|subject to the (?:following )?L
3|licen|licensed|L agreement
"""
WEIGHTS = {1: 1.0, 2: 0.8, 3: 0.4}
BASE_WEIGHT = 0.8


@dataclass(frozen=True)
class Signature:
    rank: int
    keyword: str
    label: str
    pattern: str


def signatures(lines: str = SIGNATURES) -> list[Signature]:
    """The rules of a table in the form of ``SIGNATURES``; a match starts and ends at words."""
    found = []
    for line in lines.strip().splitlines():
        rank, keyword, label, pattern = line.split("|", 3)
        pattern = pattern.replace("L", "licen[cs]e").replace("#", "(?: version| v)?")
        found.append(Signature(int(rank), keyword.replace("L", "licen"), label, rf"(?<![^ ])(?:{pattern})(?![^ ])"))
    return found


def words_text(text: Column) -> Column:
    """A-Z lower-cased, words joined by single blanks."""
    return F.trim(F.translate(F.regexp_replace(text, NOT_WORD.replace(r"\x60", r"\x40\x5B-\x60"), " "), UPPER, LOWER))


def places(words: Column, pattern: Column | str) -> Column:
    """First and last word of each match, as an array of structs."""
    marked = F.split(F.regexp_replace(words, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit("\x01$0\x02")), " ")

    def numbers(parts: Column, mark: Callable[[Column], Column]) -> Column:
        return F.array_compact(F.transform(parts, lambda word, i: F.when(mark(word), i)))

    return let(
        marked,
        lambda parts: F.arrays_zip(
            numbers(parts, lambda w: F.startswith(w, F.lit("\x01"))).alias("first"),
            numbers(parts, lambda w: F.endswith(w, F.lit("\x02"))).alias("last"),
        ),
    )


def detections(words: Column, rules: list[Signature]) -> Column:
    """All matches of all rules whose keyword stands in the text, by start, longer ones and better ranks first."""
    table = F.array(
        *[
            F.struct(
                F.lit(rule.rank).alias("rank"), F.lit(place).alias("place"), F.lit(rule.keyword).alias("keyword"),
                F.lit(rule.label).alias("label"), F.lit(rule.pattern).alias("pattern"),
            )
            for place, rule in enumerate(rules)
        ]
    )
    found = F.transform(
        F.filter(table, lambda rule: F.contains(words, rule["keyword"])),
        lambda rule: F.transform(
            places(words, rule["pattern"]),
            lambda p: F.struct(
                p["first"].alias("first"), (-p["last"]).alias("minus_last"), rule["rank"].alias("rank"),
                rule["place"].alias("place"), rule["label"].alias("label"),
            ),
        ),
    )
    return F.sort_array(F.flatten(found))


def surviving(found: Column) -> Column:
    """Labels and best weight of the detections that lie in no other of the same or a better rank.

    Whatever holds a detection stands before it, so the farthest end so far of each rank decides.
    """
    start = F.struct(
        *[F.lit(-1).alias(f"end{rank}") for rank in WEIGHTS], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("weight")
    )

    def step(seen: Column, one: Column) -> Column:
        last = -one["minus_last"]
        end = F.element_at(F.array(*[seen[f"end{rank}"] for rank in WEIGHTS]), one["rank"])
        stays = end < last
        weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS.values()]), one["rank"])
        return F.struct(
            *[
                F.when(one["rank"] <= rank, F.greatest(seen[f"end{rank}"], last)).otherwise(seen[f"end{rank}"]).alias(f"end{rank}")
                for rank in WEIGHTS
            ],
            F.when(stays, F.array_union(seen["labels"], F.array(one["label"]))).otherwise(seen["labels"]).alias("labels"),
            F.when(stays, F.greatest(seen["weight"], weight)).otherwise(seen["weight"]).alias("weight"),
        )

    return F.aggregate(found, start, step)


def scanned(docs: DataFrame, rules: list[Signature] | None = None, text: str = "text") -> DataFrame:
    """One row per document: word and base phrase counts and places, labels and score."""
    rules = signatures() if rules is None else rules
    words = F.col("words")
    has_root = F.lit(False)
    for root in ROOTS:
        has_root = has_root | F.contains(words, F.lit(root))
    nothing = F.array().cast("array<struct<first:int,last:int>>")
    hits = [
        F.when(F.contains(words, F.lit(phrase)), places(words, rf"(?<![^ ]){phrase}(?![^ ])")).otherwise(nothing).alias(f"hit{i}")
        for i, (phrase, _) in enumerate(PHRASES)
    ]
    counted = docs.select("doc_id", words_text(whole_text(text)).alias("words")).select(
        "doc_id",
        F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        *hits,
        F.when(has_root, surviving(detections(words, rules))).alias("own"),
    )
    every = F.concat(*[F.transform(F.col(f"hit{i}"), lambda p: p["first"]) for i in range(len(PHRASES))])
    base = F.concat(
        *[F.when(F.size(f"hit{i}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")) for i, (_, label) in enumerate(PHRASES)]
    )
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    own = F.coalesce(F.col("own.labels"), F.array().cast("array<string>"))
    return counted.withColumn("starts", every).select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.greatest(F.coalesce(F.col("own.weight"), F.lit(0.0)), F.when(F.size("starts") > 0, BASE_WEIGHT).otherwise(0.0)).alias("score"),
    )
