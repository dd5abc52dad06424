"""Operator 3: license scan by ordered signature rules.

A text is read as words.  Rules are regular expressions over words joined by
single spaces, each anchored at a word that is its keyword: a document without
any gate string is passed over, and at a place whose word is a keyword only
that keyword's rules are tried.  Detections are intervals of words.  Sorted by
start, longer ones first, then by priority, an interval that lies inside an
earlier one is suppressed; of equal intervals the rule with the higher
priority stays.  The base phrases are rules too, and their labels always stay.

``score`` is the highest confidence of what remains, 0 without detections.

Defined cases: null is the empty text; word numbers start from 0; repeated
rows give repeated results; other columns are ignored.  Only DataFrame
functions run on the executors; a row's work is linear in its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word, in Java's pattern syntax, of texts before and after lower-casing A-Z.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases and labels of the base.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

#: Words from a keyword on that its rules see; no rule is longer.
WINDOW = 24

#: License names as patterns over words (label: patterns), then identifiers and addresses where they differ from the label.
NAMES = {
    "apache-2.0": ["apache( software)? license( version)? 2( 0)?", "apache 2( 0)?( license)?", "apache2( 0)?( license)?", "apachev2( 0)?( license)?"],
    "apache-1.1": ["apache( software)? license( version)? 1 1"],
    "mit": ["mit( x11)? license", "expat license"],
    "mit-0": ["mit no attribution( license)?"],
    "bsd-2-clause": ["bsd 2 clause( license)?", "simplified bsd license", "freebsd license"],
    "bsd-3-clause": ["bsd 3 clause( license)?", "new bsd license", "modified bsd license", "revised bsd license"],
    "bsd-4-clause": ["bsd 4 clause( license)?", "original bsd license"],
    "0bsd": ["zero clause bsd( license)?", "bsd zero clause( license)?"],
    "gpl-1.0": ["gnu general public license( v| version )1( 0)?", "gpl v?1( 0)?", "gplv1( 0)?"],
    "gpl-2.0": ["gnu general public license( as published by the free software foundation)?( either)?( v| version )2( 0)?", "gpl v?2( 0)?", "gplv2( 0)?", "gpl2( 0)?"],
    "gpl-3.0": ["gnu general public license( as published by the free software foundation)?( either)?( v| version )3( 0)?", "gpl v?3( 0)?", "gplv3( 0)?", "gpl3( 0)?"],
    "lgpl-2.0": ["gnu library general public license( version 2( 0)?)?", "lgpl v?2( 0)?", "lgplv2( 0)?", "lgpl2( 0)?"],
    "lgpl-2.1": ["gnu lesser general public license( v| version )2 1", "lgpl v?2 1", "lgplv2 1", "lgpl2 1"],
    "lgpl-3.0": ["gnu lesser general public license( v| version )3( 0)?", "lgpl v?3( 0)?", "lgplv3( 0)?", "lgpl3( 0)?"],
    "lgpl": ["gnu lesser general public license", "lesser gpl"],
    "agpl-3.0": ["gnu affero general public license( v| version )3( 0)?", "agpl v?3( 0)?", "agplv3( 0)?", "agpl3( 0)?"],
    "agpl": ["gnu affero general public license", "affero gpl"],
    "mpl-1.1": ["mozilla public license( v| version )1 1", "mpl 1 1", "mplv1 1"],
    "mpl-2.0": ["mozilla public license( v| version )2( 0)?", "mpl 2( 0)?", "mplv2( 0)?", "mpl2( 0)?"],
    "epl-1.0": ["eclipse public license( v| version )1( 0)?", "epl v?1( 0)?", "eplv1( 0)?"],
    "epl-2.0": ["eclipse public license( v| version )2( 0)?", "epl v?2( 0)?", "eplv2( 0)?"],
    "cddl-1.0": ["common development and distribution license( version 1( 0)?)?", "cddl( 1 0)?"],
    "cc-by-3.0": ["creative commons attribution 3 0( unported)?( license)?", "cc by 3 0"],
    "cc-by-4.0": ["creative commons attribution 4 0( international)?( public)?( license)?", "cc by 4 0"],
    "cc-by-sa-3.0": ["creative commons attribution sharealike 3 0( unported)?( license)?", "cc by sa 3 0"],
    "cc-by-sa-4.0": ["creative commons attribution sharealike 4 0( international)?( license)?", "cc by sa 4 0"],
    "cc-by-sa": ["creative commons attribution sharealike", "cc by sa"],
    "cc-by-nc-4.0": ["creative commons attribution noncommercial 4 0( international)?( license)?", "cc by nc 4 0"],
    "cc-by-nc": ["creative commons attribution noncommercial", "cc by nc"],
    "cc-by-nd": ["creative commons attribution noderivatives", "cc by nd"],
    "cc-by-nc-sa": ["creative commons attribution noncommercial sharealike", "cc by nc sa"],
    "cc-by-nc-nd": ["creative commons attribution noncommercial noderivatives", "cc by nc nd"],
    "cc0-1.0": ["cc0( 1 0)?( universal)?", "creative commons zero"],
    "unlicense": ["unlicense", "this is free and unencumbered software released into the public domain"],
    "isc": ["isc license", "internet systems consortium license"],
    "zlib": ["zlib license", "zlib libpng license"],
    "bsl-1.0": ["boost software license( version 1 0)?"],
    "artistic-2.0": ["artistic license 2( 0)?"],
    "artistic-1.0": ["artistic license( 1( 0)?)?"],
    "wtfpl": ["wtfpl", "do what the fuck you want to public license"],
    "ofl-1.1": ["sil open font license( version)?( 1 1)?", "ofl 1 1"],
    "odbl-1.0": ["open database license( version)?( 1 0)?", "odbl( 1 0)?"],
    "eupl-1.2": ["european union public licence( v 1 2)?", "eupl( 1 2)?"],
    "ms-pl": ["microsoft public license"],
    "python-2.0": ["python software foundation license( version 2)?"],
    "postgresql": ["postgresql license"],
    "ncsa": ["university of illinois ncsa open source license"],
    "openssl": ["openssl license"],
    "php-3.01": ["php license( version 3 01)?"],
    "vim": ["vim license"],
    "w3c": ["w3c software( notice and)? license"],
    "public-domain": ["public domain dedication", "dedicated to the public domain", "released into the public domain"],
    "proprietary": ["all rights reserved", "proprietary and confidential"],
    "gpl": ["gpl", "gnu gpl"],
    "copyright-notice": ["copyright c? ?[0-9]{4}"],
}
ADDRESSES = {
    "apache-2.0": ["apache org licenses license 2 0"], "mit": ["opensource org licenses mit( license)?", "choosealicense com licenses mit"],
    "bsd-3-clause": ["opensource org licenses bsd 3 clause"], "bsd-2-clause": ["opensource org licenses bsd 2 clause"],
    "gpl-2.0": ["gnu org licenses( old licenses)? gpl 2 0"], "gpl-3.0": ["gnu org licenses gpl( 3 0)?"],
    "lgpl-3.0": ["gnu org licenses lgpl( 3 0)?"], "agpl-3.0": ["gnu org licenses agpl( 3 0)?"],
    "mpl-2.0": ["mozilla org mpl 2 0"], "epl-2.0": ["eclipse org legal epl 2 0"],
    "cc-by-4.0": ["creativecommons org licenses by 4 0"], "cc-by-sa-4.0": ["creativecommons org licenses by sa 4 0"],
    "cc-by-sa-3.0": ["creativecommons org licenses by sa 3 0"], "cc-by-3.0": ["creativecommons org licenses by 3 0"],
    "cc-by-nc-4.0": ["creativecommons org licenses by nc 4 0"], "cc0-1.0": ["creativecommons org publicdomain zero 1 0"],
    "unlicense": ["unlicense org"], "bsl-1.0": ["boost org license 1 0"], "ofl-1.1": ["scripts sil org ofl"],
}
#: Sentences of the licenses' own texts (grants, conditions, warranties) that tell the label without its name.
#: "bsd" is what all texts of that family begin with; the grant of "mit" also begins those of mit-0 and ncsa.
BODIES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "furnished to do so subject to the following conditions the above copyright notice and this permission notice"],
    "mit-0": ["furnished to do so the software is provided as is without warranty of any kind"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "bsd-2-clause": ["materials provided with the distribution this software is provided by"],
    "bsd-3-clause": ["names of (its|the|their) contributors may be used to endorse or promote products derived from this software"],
    "bsd-4-clause": ["all advertising materials mentioning features or use of this software must display the following acknowledge?ment"],
    "isc": ["permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted provided that"],
    "0bsd": ["permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted the software"],
    "postgresql": ["permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"],
    "ncsa": ["deal with the software without restriction including without limitation the rights to use"],
    "zlib": ["this software is provided as is without any express or implied warranty", "altered source versions must be plainly marked as such"],
    "bsl-1.0": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"],
    "ofl-1.1": ["permission is hereby granted free of charge to any person obtaining a copy of the font software"],
    "apache-2.0": ["each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"],
    "gpl": ["everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"],
    "gpl-2.0": ["copy and distribute verbatim copies of the program s source code as you receive it in any medium"],
    "gpl-3.0": ["convey verbatim copies of the program s source code as you receive it in any medium"],
    "lgpl-2.1": ["copy and distribute verbatim copies of the library s complete source code as you receive it in any medium"],
    "agpl-3.0": ["modified version must prominently offer all users interacting with it remotely through a computer network"],
    "mpl-2.0": ["covered software is provided under this license on an as is basis without warranty of any kind either expressed implied or statutory"],
    "mpl-1.1": ["covered code is provided under this license on an as is basis without warranty of any kind"],
    "cddl-1.0": ["covered software is provided under this license on an as is basis without warranty of any kind either expressed or implied"],
    "epl-1.0": ["except as expressly set forth in this agreement the program is provided on an as is basis"],
    "epl-2.0": ["except as expressly set forth in this agreement and to the extent permitted by applicable law the program is provided"],
    "cc0-1.0": ["affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"],
    "unlicense": ["anyone is free to copy modify publish use compile sell or distribute this software"],
    "wtfpl": ["just do what the fuck you want to"],
    "openssl": ["product includes software developed by the openssl project for use in the openssl toolkit"],
    "php-3.01": ["product includes php software freely available from"],
}
#: Words before a name that make it a notice.
NOTICES = ["licensed under( the)?( terms of the)?", "released under( the)?( terms of the)?", "distributed under( the)?( terms of the)?", "available under( the)?( terms of the)?"]


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str  # over words joined by single spaces
    keyword: str  # its first word
    priority: int
    confidence: float
    base: bool = False


def _rule(label: str, pattern: str, priority: int, confidence: float, base: bool = False) -> Rule:
    return Rule(label, pattern, pattern.split(" ")[0].split("(")[0], priority, confidence, base)


def rules() -> list[Rule]:
    """All rules: identifiers, notices, addresses, names, sentences, and last the base phrases."""
    out = []
    for label, names in NAMES.items():
        if label not in ("proprietary", "copyright-notice", "public-domain", "gpl"):
            tag = label.replace("-", " ").replace(".", " ")
            out.append(_rule(label, f"spdx license identifier {tag}( only| or later)?", 90, 1.0))
        either = "|".join(names)
        if label not in ("proprietary", "copyright-notice"):
            out += [_rule(label, f"{notice} ({either})", 80, 0.95) for notice in NOTICES]
        out += [_rule(label, address, 70, 0.9) for address in ADDRESSES.get(label, [])]
        weak = label in ("proprietary", "copyright-notice")
        out += [_rule(label, name, 20 if weak else 60, 0.3 if weak else 0.8) for name in names]
    out += [_rule(label, sentence, 65, 0.85) for label, sentences in BODIES.items() for sentence in sentences]
    return out + [_rule(label, phrase, 50, 0.7, True) for phrase, label in BASE]


#: Every rule's detections contain one of these strings once a text is lower-cased and its marks become spaces or nothing.
GATES = ["licen", "spdx", "gpl", "gnu", "apache", "cc", "bsd", "mpl", "epl", "cddl", "creative", "commons", "wtfpl", "ofl", "odbl", "eupl", "domain", "rights", "proprietary", "copyright", "opensource", "attribution", "permission", "permitted", "hereby", "provided", "distribut", "verbatim", "furnished", "contributors", "advertising", "altered", "remotely", "covered", "affirmer", "fuck", "openssl", "freely"]


def _gate(low: Column) -> Column:
    out = F.lit(False)
    for g in GATES:
        out = out | F.contains(low, F.lit(g))
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``n_words``, ``detections`` (kept intervals: first and
    last word, label, priority, confidence) and ``base`` (places of the base phrases)."""
    rule_list = rules()
    table = F.array(*[F.struct(F.lit(r.keyword).alias("keyword"), F.lit(f"^({r.pattern})(?= |$)").alias("pattern"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"), F.lit(r.label).alias("label"), F.lit(r.base).alias("base")) for r in rule_list])
    keywords = sorted({r.keyword for r in rule_list})
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.select(F.col(key).alias("doc_id"), said.alias("said"), F.lower(said).alias("low"))
    df = df.select("doc_id", F.regexp_count("said", F.lit(ANY_WORD)).cast("long").alias("n_words"), F.when(_gate(F.col("low")), F.regexp_extract_all(F.translate("said", UPPER, LOWER), F.lit(ANY_WORD), F.lit(0))).alias("words"))
    spots = F.filter(F.transform("words", lambda w, i: F.when(w.isin(keywords), F.struct(i.alias("at"), w.alias("word")))), lambda s: s.isNotNull())
    df = df.select("doc_id", "n_words", F.transform(spots, lambda s: F.struct(s["at"].alias("at"), s["word"].alias("word"), F.array_join(F.slice(F.col("words"), s["at"] + 1, F.lit(WINDOW)), " ").alias("said"))).alias("spots"))

    def tried(s: Column) -> Column:
        own = F.filter(table, lambda r: r["keyword"] == s["word"])
        got = F.transform(own, lambda r: F.struct(r["label"].alias("label"), r["priority"].alias("priority"), r["confidence"].alias("confidence"), r["base"].alias("base"), F.regexp_substr(s["said"], r["pattern"]).alias("found")))
        return F.transform(
            F.filter(got, lambda g: g["found"].isNotNull()),
            lambda g: F.struct(
                s["at"].alias("first"), (-(s["at"] + F.size(F.split(g["found"], " ")) - 1)).alias("minus_last"), (-g["priority"]).alias("minus_priority"),
                g["label"].alias("label"), g["confidence"].alias("confidence"), g["base"].alias("base"),
            ),
        )

    df = df.select("doc_id", "n_words", F.filter(F.transform("spots", tried), lambda d: F.size(d) > 0).alias("found"))
    # of one start only the longest can stay, of equal ones that of the highest priority
    df = df.withColumn("best", F.transform("found", lambda d: F.array_min(d)))

    def stays(d: Column, i: Column) -> Column:
        """No detection that starts earlier ends where this one does or later;
        none is longer than the window, so the spots before it suffice."""
        before = F.slice(F.col("best"), F.greatest(i - (WINDOW - 2), F.lit(1)), F.least(i, F.lit(WINDOW - 1)))
        return -d["minus_last"] > F.coalesce(F.array_max(F.transform(before, lambda b: -b["minus_last"])), F.lit(-1))

    kept = F.transform(
        F.filter("best", stays),
        lambda d: F.struct(d["first"].alias("first"), (-d["minus_last"]).alias("last"), d["label"].alias("label"), (-d["minus_priority"]).alias("priority"), d["confidence"].alias("confidence")),
    )
    none = F.array().cast("array<struct<first:int,last:int,label:string,priority:int,confidence:double>>")
    base = F.transform(F.filter(F.flatten("found"), lambda d: d["base"]), lambda d: F.struct(d["first"].alias("first"), (-d["minus_last"]).alias("last"), d["label"].alias("label")))
    return df.select("doc_id", "n_words", F.coalesce(kept, none).alias("detections"), F.coalesce(base, F.array().cast("array<struct<first:int,last:int,label:string>>")).alias("base"))


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The digest of :func:`scan`."""
    found = scan(docs, key, text)
    base_labels = F.array_distinct(F.transform("base", lambda b: b["label"]))
    labels = F.array_union(base_labels, F.transform("detections", lambda d: d["label"]))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["first"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )
