"""License scans: known licence sentences, and ordered rules over the sentences found.

A text is cut into blocks after ``. ! ? ; :`` before white space, and blocks into lines. A line is
normalised (A-Z in lower case, runs of other ASCII signs as one space; so signs of a comment before
it do not count). Each run of adjacent lines of a block, joined by a space, is looked up among the
sentences that licences and their notices consist of: a sentence can be on one line or wrapped at
any of its words. A line without letters and digits ends a run. What is left of a document is the
sequence of known sentences. A rule is a sequence too, and matches where its sentences follow one
another in the document with no other known sentence between.

Only lines that are a part of a known sentence, cut between words, are looked at further, so a run
has no more lines than the longest known sentence has words.

Defined cases: a known sentence within a longer known one is not counted beside it; null and empty
texts have no sentences and no licence; repeated rows give repeated results; rows that share a
doc_id but not the text are judged apart; a rule that matches twice is reported once; columns beyond
doc_id and text are ignored. The known sentences and their parts are a fixed table, so broadcasting
them is bounded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import ascii_lower

#: Sentences of public licences and notices, by an identifier of our own.
SENTENCES = {
    "apache-header": "Licensed under the Apache License, Version 2.0",
    "apache-header-long": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
    "CONDITIONS OF ANY KIND, either express or implied",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may "
    "be used to endorse or promote products derived from this software without specific prior "
    "written permission",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or "
    "neighboring rights to this work",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "gpl2-later": "either version 2 of the License, or (at your option) any later version",
    "gpl3-later": "either version 3 of the License, or (at your option) any later version",
    "gpl3-redistribute-later": "you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose "
    "with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies",
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    'this software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
}

#: A licence, and the sentences that must follow one another.
RULES = (
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-header-long", "apache-comply")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC0-1.0", ("cc0",)),
    ("GPL-2.0", ("gpl2-work",)),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-redistribute", "gpl2-later")),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl2-redistribute", "gpl3-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-redistribute-later")),
    ("ISC", ("isc-grant",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MPL-2.0", ("mpl-notice",)),
)
#: A match of the first is part of a match of the second, and not reported beside it.
WITHIN = (("BSD-2-Clause", "BSD-3-Clause"),)

END = r"(?<=[.!?;:])[\x20\x09-\x0D]+"
LINE = r"\x0D\x0A|[\x0A\x0D]"
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(sentence), OTHER, " "))


def known_sentences(documents: DataFrame, sentences: dict[str, str]) -> DataFrame:
    """Known sentences of every text: doc_id, text_key, block and line of the start, identifier."""
    spark = documents.sparkSession
    pair = [F.struct(F.lit(k).alias("sentence_id"), F.lit(v).alias("s")) for k, v in sentences.items()]
    pairs = F.array(*pair)
    known = spark.range(1).select(F.explode(pairs).alias("p")).select(
        "p.sentence_id", normalised(F.col("p.s")).alias("sentence")
    )
    words = F.split("sentence", " ")
    first = known.select(words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words))).alias("i"))
    some = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("i") + 1))
    parts = first.select("w", "i", some.alias("n")).select(
        F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("part")
    )
    longest = max(len(re.split(OTHER, s)) for s in sentences.values())
    key = F.xxhash64("text").alias("text_key")
    cut = F.posexplode(F.split("text", END)).alias("block", "text")
    blocks = documents.select("doc_id", key, cut)
    cut = F.posexplode(F.split("text", LINE)).alias("line", "part")
    lines = blocks.select("doc_id", "text_key", "block", cut)
    lines = lines.withColumn("part", normalised(F.col("part"))).join(
        F.broadcast(parts), "part", "left_semi"
    )
    block = Window.partitionBy("doc_id", "text_key", "block")
    # a repeated row has the same lines: sets hold them once
    ahead = F.collect_set(F.struct("line", "part")).over(
        block.orderBy("line").rangeBetween(0, longest - 1)
    )
    lines = lines.withColumn("ahead", F.sort_array(ahead))
    adjacent = F.filter(
        F.sequence(F.lit(1), F.size("ahead")),
        lambda n: F.get("ahead", n - 1)["line"] == F.col("line") + n - 1,
    )
    runs = lines.select("doc_id", "text_key", "block", "line", "ahead", F.explode(adjacent).alias("n"))
    runs = runs.withColumn("sentence", F.array_join(F.slice("ahead.part", F.lit(1), F.col("n")), " "))
    found = runs.drop("ahead").join(F.broadcast(known), "sentence")
    # what ends no later than one that starts before, or with it and is longer, lies within that
    stop = F.col("line") + F.col("n")
    before = block.orderBy("line", F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("reached", F.max(stop).over(before))
    return found.where(F.col("reached").isNull() | (stop > F.col("reached")))


def licenses(
    documents: DataFrame,
    sentences: dict[str, str] = SENTENCES,
    rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES,
) -> DataFrame:
    """Per document row: number and sequence of known sentences, and the licences they make."""
    found = (
        known_sentences(documents, sentences)
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set(F.struct("block", "line", "sentence_id"))).alias("seq"))
        .select(
            F.col("doc_id").alias("in_doc"),
            F.col("text_key").alias("in_key"),
            F.size("seq").alias("n_known"),
            F.array_join("seq.sentence_id", ",").alias("sentence_ids"),
        )
    )
    chain = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    hit = [
        F.when(F.contains(chain, F.lit(f",{','.join(ids)},")), F.lit(name)) for name, ids in rules
    ]
    names = F.array_distinct(F.array_compact(F.array(*hit)))
    for inner, outer in WITHIN:
        less = F.array_remove(names, inner)
        names = F.when(F.array_contains(names, outer), less).otherwise(names)
    found = found.withColumn("licenses", F.array_join(F.sort_array(names), ","))
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_key") == F.col("in_key"))
    return docs.join(found, same, "left").select(
        "doc_id",
        F.coalesce("n_known", F.lit(0)).cast("long").alias("n_known"),
        F.coalesce("sentence_ids", F.lit("")).alias("sentence_ids"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
    )
