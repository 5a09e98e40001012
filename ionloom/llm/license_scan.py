"""Licence recognition by sentence rules.

A text is cut into sentences (after . ! ? : ; and white space, and at blank lines), and these into pieces at line breaks
before a capital, a digit, a bullet or a comment leader. A piece is lower-cased and its runs of letters and digits joined
by one space. From each piece on, the longest run of pieces of its sentence that makes a known licence sentence becomes
that sentence's identifier, so wrapped notices and comments count like lines of their own; the rest is left out. A rule is
an ordered run of identifiers with at most GAP other sentences between two of them. Where rules overlap the longest wins,
whatever licence it belongs to: one that lies within a longer one is not reported. A licence that several rules find has
one row, that of the longest, or of the first listed.

Pieces meet the known sentences, and identifiers the rules, by broadcast equi-joins, so that neither grows the work of a
row. A sentence of many pieces is dealt into blocks of BLOCK before any run is joined, each with the pieces that a run may
still need; a run ends where it gets longer than the longest known sentence, so a text of any length without a stop costs
rows in proportion to its pieces and none that grows with it.

A null or empty text has no sentences and no licence; rows without a licence give no row. Repeated rows are reported
each. Of rules of equal length over the same sentences all licences are reported. No rows give no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ionloom.llm.common import materialize

#: Unknown sentences that may lie between two of a rule; rows of either table up to which it is broadcast.
GAP, BROADCAST_ROWS = 3, 200_000
#: Pieces of a sentence that are searched for runs together.
BLOCK = 256

# Sentences of public licence texts and notices.
SENTENCES = {
    "mit_release": "Released under the MIT License.",
    "mit_licensed": "Licensed under the MIT License.",
    "mit_this": "This project is licensed under the MIT License.",
    "mit_title": "The MIT License (MIT)",
    "mit_name": "MIT License",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache_short": "Licensed under the Apache License, Version 2.0.",
    "apache_named": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache_comply": "you may not use this file except in compliance with the License.",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3_work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3_licensed": "Licensed under the GNU General Public License, version 3.",
    "gpl_free": "This program is free software:",
    "gpl3_redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2_redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl_version": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "lgpl_free": "This library is free software;",
    "lgpl21_redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3_redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3_redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_neither": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd_retain": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd_reproduce": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc0_short": "Licensed under CC0 1.0.",
    "mpl_subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense_anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "mit_asis": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "json_good": "The Software shall be used for Good, not Evil.",
    "x11_name": "Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium.",
    "mit0_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "bsd_advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd_asis": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "zerobsd_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "isc_asis": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "gpl_fitness": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_details": "See the GNU General Public License for more details.",
    "gpl2_free": "This program is free software;",
    "agpl_details": "See the GNU Affero General Public License for more details.",
    "lgpl2_redistribute": "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gfdl_grant": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation;",
    "mpl11_subject": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\");",
    "cddl_subject": "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\").",
    "epl1_terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl2_terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2_www": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/",
    "zlib_asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib_liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib_origin": "The origin of this software must not be misrepresented;",
    "bsl_distributed": "Distributed under the Boost Software License, Version 1.0.",
    "bsl_title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl_grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "artistic_perl": "you can redistribute it and/or modify it under the same terms as Perl itself.",
    "artistic2_terms": "you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    "artistic2_title": "The Artistic License 2.0",
    "wtfpl_title": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "wtfpl_do": "You just DO WHAT THE FUCK YOU WANT TO.",
    "ofl_licensed": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "eupl_licensed": "Licensed under the EUPL, Version 1.2 or \u2013 as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\");",
    "eupl_short": "Licensed under the EUPL, Version 1.2.",
    "mspl_governs": "This license governs use of the accompanying software.",
    "mspl_title": "Microsoft Public License (Ms-PL)",
    "ncsa_title": "University of Illinois/NCSA Open Source License",
    "postgres_grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    "psf_agreement": "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2",
    "php_subject": "This source file is subject to version 3.01 of the PHP license, that is bundled with this package in the file LICENSE, and is available through the world-wide-web at the following url:",
    "openssl_ack": "\"This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit.",
    "beer_ware": "As long as you retain this notice you can do whatever you want with this stuff.",
    "ecl_licensed": "Licensed under the Educational Community License, Version 2.0 (the \"License\");",
    "afl_licensed": "Licensed under the Academic Free License version 3.0",
    "osl_licensed": "Licensed under the Open Software License version 3.0",
    "upl_licensed": "Licensed under the Universal Permissive License v 1.0 as shown at https://oss.oracle.com/licenses/upl.",
    "blueoak_title": "Blue Oak Model License",
    "blueoak_purpose": "This license gives everyone as much permission to work with this software as possible, while protecting contributors from liability.",
    "hpnd_grant": "Permission to use, copy, modify, distribute, and sell this software and its documentation for any purpose is hereby granted without fee, provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation.",
    "ftl_title": "The FreeType Project LICENSE",
    "w3c_notice": "This work is being provided by the copyright holders under the following license.",
    "vim_title": "VIM LICENSE",
    "apache11_ack": "\"This product includes software developed by the Apache Software Foundation (http://www.apache.org/).",
    "cecill_governed": "This software is governed by the CeCILL license under French law and abiding by the rules of distribution of free software.",
    "cc0_waived": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
}
# Creative Commons names every licence and version by the same two sentences; version 4.0 says International, 3.0 Unported.
CREATIVE_COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
RULES = {
    "MIT": [["mit_title", "mit_grant", "mit_notice", "mit_asis"], ["mit_name", "mit_grant", "mit_notice", "mit_asis"], ["mit_grant", "mit_notice", "mit_asis"], ["mit_title", "mit_grant", "mit_notice"], ["mit_name", "mit_grant", "mit_notice"], ["mit_grant", "mit_notice"], ["mit_release"], ["mit_licensed"], ["mit_this"]],
    "Apache-2.0": [["apache_named", "apache_comply", "apache_copy", "apache_asis", "apache_see"], ["apache_named", "apache_comply", "apache_copy"], ["apache_named", "apache_comply"], ["apache_short"]],
    "GPL-3.0": [["gpl_free", "gpl3_redistribute", "gpl_hope", "gpl_fitness", "gpl_details"], ["gpl_free", "gpl3_redistribute", "gpl_hope"], ["gpl_free", "gpl3_redistribute"], ["gpl3_work"], ["gpl3_licensed"]],
    "GPL-2.0": [["gpl2_free", "gpl2_redistribute", "gpl_hope", "gpl_fitness", "gpl_details"], ["gpl2_free", "gpl2_redistribute"], ["gpl2_free", "gpl_version"], ["gpl_free", "gpl2_redistribute", "gpl_hope"], ["gpl_free", "gpl2_redistribute"], ["gpl_free", "gpl_version"]],
    "LGPL-2.0": [["lgpl_free", "lgpl2_redistribute"]],
    "LGPL-2.1": [["lgpl_free", "lgpl21_redistribute"]],
    "LGPL-3.0": [["gpl_free", "lgpl3_redistribute"], ["lgpl_free", "lgpl3_redistribute"]],
    "AGPL-3.0": [["gpl_free", "agpl3_redistribute", "gpl_hope", "gpl_fitness", "agpl_details"], ["gpl_free", "agpl3_redistribute"]],
    "BSD-3-Clause": [["bsd_grant", "bsd_retain", "bsd_reproduce", "bsd_neither", "bsd_asis"], ["bsd_grant", "bsd_retain", "bsd_reproduce", "bsd_neither"]],
    "BSD-4-Clause": [["bsd_grant", "bsd_retain", "bsd_reproduce", "bsd_advertising", "bsd_neither"]],
    "BSD-2-Clause": [["bsd_grant", "bsd_retain", "bsd_reproduce", "bsd_asis"], ["bsd_grant", "bsd_retain", "bsd_reproduce"]],
    "ISC": [["isc_grant", "isc_asis"], ["isc_grant"]],
    "CC0-1.0": [["cc0_short"], ["cc0_waived"]],
    "MPL-2.0": [["mpl_subject"]],
    "Unlicense": [["unlicense", "unlicense_anyone"], ["unlicense"]],
    "JSON": [["mit_grant", "mit_notice", "json_good"]],
    "X11": [["mit_grant", "mit_notice", "mit_asis", "x11_name"], ["mit_grant", "mit_notice", "x11_name"]],
    "MIT-0": [["mit0_grant"]],
    "0BSD": [["zerobsd_grant"]],
    "GFDL-1.3": [["gfdl_grant"]],
    "MPL-1.1": [["mpl11_subject", "apache_comply"], ["mpl11_subject"]],
    "CDDL-1.0": [["cddl_subject", "apache_comply"], ["cddl_subject"]],
    "EPL-1.0": [["epl1_terms"]],
    "EPL-2.0": [["epl2_terms"], ["epl2_www"]],
    "Zlib": [["zlib_asis", "zlib_liable", "zlib_grant", "zlib_origin"], ["zlib_asis", "zlib_liable", "zlib_grant"]],
    "BSL-1.0": [["bsl_distributed"], ["bsl_title", "bsl_grant"], ["bsl_grant"]],
    "Artistic-1.0-Perl": [["gpl2_free", "artistic_perl"], ["lgpl_free", "artistic_perl"]],
    "Artistic-2.0": [["gpl2_free", "artistic2_terms"], ["artistic2_title"]],
    "WTFPL": [["wtfpl_title"], ["wtfpl_do"]],
    "OFL-1.1": [["ofl_licensed"]],
    "EUPL-1.2": [["eupl_licensed"], ["eupl_short"]],
    "MS-PL": [["mspl_title", "mspl_governs"], ["mspl_title"]],
    "NCSA": [["ncsa_title"]],
    "PostgreSQL": [["postgres_grant"]],
    "Python-2.0": [["psf_agreement"]],
    "PHP-3.01": [["php_subject"]],
    "OpenSSL": [["openssl_ack"]],
    "Beerware": [["beer_ware"]],
    "ECL-2.0": [["ecl_licensed", "apache_comply"], ["ecl_licensed"]],
    "AFL-3.0": [["afl_licensed"]],
    "OSL-3.0": [["osl_licensed"]],
    "UPL-1.0": [["upl_licensed"]],
    "BlueOak-1.0.0": [["blueoak_title", "blueoak_purpose"], ["blueoak_purpose"]],
    "HPND": [["hpnd_grant"]],
    "FTL": [["ftl_title"]],
    "W3C": [["w3c_notice"]],
    "Vim": [["vim_title"]],
    "Apache-1.1": [["apache11_ack"]],
    "CECILL-2.1": [["cecill_governed"]],
}

for _code, _name in CREATIVE_COMMONS.items():
    for _version, _kind in (("4.0", "International"), ("3.0", "Unported")):
        _key = f"cc{_code.replace('-', '')}{'' if _version == '4.0' else '3'}".lower()
        SENTENCES |= {f"{_key}_short": f"Licensed under CC {_code} {_version}.", f"{_key}_work": f"This work is licensed under a Creative Commons {_name} {_version} {_kind} License."}
        RULES[f"CC-{_code}-{_version}"] = [[f"{_key}_short"], [f"{_key}_work"]]

_CUT, _WRAP = "\x01", "\x02"
_NORMAL = r"trim(regexp_replace(lower(s), '[^\\p{L}\\p{N}]+', ' '))"
# Comment leaders that are a word or would end a sentence, and line breaks before which a piece ends.
_WORD_LEADER = r"(?m)^[ \t]*(?:dnl|DNL|rem|REM|;+|!+)[ \t]"
_BREAK = r"\n(?=[ \t]*(?:[A-Z0-9*(\"#;%-]|//|<!--))"


def split_known(sentence: str) -> list[str]:
    """The normal forms of the sentences in one listed sentence: the cut may fall inside it (v. 2.0)."""
    parts = re.split(r"(?<=[.!?:;])\s+", sentence)
    return [x for x in (re.sub(r"[\W_]+", " ", p.lower()).strip() for p in parts) if x]


def _tables(sentences: dict[str, str], rules: dict[str, list[list[str]]]) -> tuple[dict[str, str], list[tuple[str, str, list[str]]]]:
    """(identifier by normal form, (licence, rule name, its identifiers))."""
    known, runs = {}, {}
    for name, sentence in sentences.items():
        parts = split_known(sentence)
        for i, part in enumerate(parts):
            known.setdefault(part, name if len(parts) == 1 else f"{name}.{i}")
        runs[name] = [known[p] for p in parts]
    return known, [(licence, "+".join(rule), [x for name in rule for x in runs[name]]) for licence, options in rules.items() for rule in options]


def scan(df: DataFrame, sentences: dict[str, str] | None = None, rules: dict[str, list[list[str]]] | None = None) -> DataFrame:
    """doc_id, licence, rule and n_sentences (known sentences of the document) for every licence of every row."""
    spark = df.sparkSession
    known, ordered = _tables(sentences or SENTENCES, rules or RULES)
    sent = lambda side, rows: F.broadcast(side) if rows <= BROADCAST_ROWS else side
    forms = sent(spark.createDataFrame(list(known.items()), "form string, sid string"), len(known))
    listed = sent(spark.createDataFrame([(run[0], run, licence, rule, i) for i, (licence, rule, run) in enumerate(ordered)], "head string, run array<string>, licence string, rule string, place int"), len(ordered))

    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), _WORD_LEADER, "# ")
    cut = F.regexp_replace(F.regexp_replace(text, r"([.!?:;])\s+", f"$1{_CUT}"), r"\n\s*\n", _CUT)
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.split(F.regexp_replace(cut, _BREAK, _WRAP), _CUT).alias("parts"))
    most, longest = max(len(form.split(" ")) for form in known), max(map(len, known))  # a sentence has no more pieces than words
    begins = ", ".join(f"'{word}'" for word in sorted({form.split(" ")[0] for form in known}))
    sentences_ = docs.select("row", "doc_id", F.posexplode_outer("parts").alias("s", "part"))
    pieces = f"filter(transform(split(part, '{_WRAP}'), s -> left({_NORMAL}, {longest + 1})), s -> s <> '')"  # longer ones are in no run
    cut_up = sentences_.select("row", "doc_id", "s", F.expr(pieces).alias("pieces"))
    blocks = f"transform(sequence(0, size(pieces) - 1, {BLOCK}), b -> struct(b, slice(pieces, b + 1, {BLOCK + most - 1}) AS ps))"
    dealt = cut_up.where(F.size("pieces") > 0).select("row", "doc_id", "s", F.explode_outer(F.expr(blocks)).alias("x")).select("row", "doc_id", "s", "x.b", "x.ps")
    # what stands from each piece on that begins like a known sentence, no longer than one; then its runs, by their pieces' ends
    ahead = f"transform(ps, (p, i) -> IF(i < {BLOCK} AND substring_index(p, ' ', 1) IN ({begins}), left(concat(array_join(slice(ps, i + 1, {most}), '{_WRAP}'), '{_WRAP}'), {longest + 1}), NULL))"
    open_ = dealt.select("row", "doc_id", "s", "b", F.posexplode_outer(F.expr(ahead)).alias("i", "next")).where("next IS NOT NULL")
    ends = F.expr(f"length(next) - length(replace(next, '{_WRAP}', ''))")
    runs = open_.select("row", "doc_id", "s", (F.col("b") + F.col("i")).alias("p"), "next", ends.alias("ends")).where("ends > 0")
    asked = runs.select("row", "doc_id", "s", "p", "next", F.explode_outer(F.sequence(F.lit(1), "ends")).alias("k")).select("row", "doc_id", "s", "p", "k", F.expr(f"replace(substring_index(next, '{_WRAP}', k), '{_WRAP}', ' ')").alias("f"))
    hits = materialize(asked.join(forms, asked["f"] == forms["form"]).select("row", "doc_id", "s", "p", "k", "sid"), "license-hits")  # rows keep their numbers from here on

    longest = hits.repartition("row").groupBy("row", "doc_id", "s", "p").agg(F.max_by("sid", "k").alias("sid"))
    row, order = Window.partitionBy("row"), Window.partitionBy("row").orderBy("s", "p")
    ahead = order.rowsBetween(0, max(len(run) for _, _, run in ordered) - 1)  # no rule looks farther
    placed = longest.select("row", "doc_id", F.count("*").over(row).alias("n_sentences"), F.row_number().over(order).alias("at"), F.collect_list(F.struct("s", "sid")).over(ahead).alias("seq"))
    own = "slice(seq, 1, size(run))"
    near = f"forall(sequence(1, size(run)), i -> i = 1 OR get({own}, i - 1).s - get({own}, i - 2).s <= {GAP + 1})"
    same = placed.join(listed, F.expr("seq[0].sid") == F.col("head")).where(F.expr(f"transform({own}, x -> x.sid) = run")).where(F.expr(near)).withColumn("to", F.col("at") + F.size("run"))
    earlier = F.max("to").over(row.orderBy("at").rangeBetween(Window.unboundedPreceding, -1))
    spans = same.select("*", F.coalesce(earlier, F.lit(0)).alias("earlier"), F.max("to").over(Window.partitionBy("row", "at")).alias("longest"))
    kept = spans.where((F.col("earlier") < F.col("to")) & (F.col("longest") == F.col("to")))
    best = kept.groupBy("row", "doc_id", "n_sentences", "licence").agg(F.max_by("rule", F.struct(F.size("run"), -F.col("place"))).alias("rule"))
    return best.select("doc_id", "licence", "rule", "n_sentences")
