"""Everyday notices and license texts, and others of their kind."""

import pytest

from fareloom.llm import license

WARRANTY = license.TEMPLATES["MIT-warranty"]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(f"Some words of a file stand here.\n{t}\nand others follow after it." for t in texts)), "doc_id long, text string")
    rows = license.license_scan(df).collect()
    return [sorted({r.license for r in rows if r.doc_id == i}) for i in range(len(texts))]


NOTICES = {
    "SPDX-License-Identifier: MIT": "MIT",
    "// SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0",
    "Licensed under the MIT license.": "MIT",
    "This project is licensed under the MIT License": "MIT",
    "Distributed under the terms of the GNU General Public License v3.0": "GPL-3.0",
    "Licensed under the Apache License 2.0": "Apache-2.0",
    WARRANTY: "MIT",
    "Mozilla Public License Version 2.0": "MPL-2.0",
    "Released under the MIT-License": "MIT",
    "released under the BSD 3-Clause License": "BSD-3-Clause",
    "You may use it under the terms of the GNU Lesser General Public License Version 2.1": "LGPL-2.1",
    "This code is in the public domain under the Unlicense": "Unlicense",
    "made available under the Eclipse Public License v2.0": "EPL-2.0",
}


def test_everyday_notices(spark):
    for names, (text, want) in zip(found(spark, NOTICES), NOTICES.items(), strict=True):
        assert names and all(n == want or n.startswith(f"{want}-") for n in names), (text, names)


def test_whole_texts_are_told_apart(spark):
    names = [*license.TEXTS]
    texts = [license.TEXTS[n].replace("software", "software  \n *", 1).replace("use", "usage", 1) for n in names]
    assert found(spark, texts) == [[n] for n in names]


@pytest.mark.parametrize("text", [
    "Distributed under the terms of the GNU General Public License", "Licensed under the terms of our contract",
    "SPDX-License-Identifier: Proprietary", "The institute MIT gave a license to the firm under the old law",
    "under the GNU Library General Public License v3.0", "Mozilla Public Radio Version 2.0",
])
def test_other_texts_have_none(spark, text):
    assert found(spark, [text]) == [[]]


def test_two_identifiers_of_a_choice(spark):
    assert found(spark, ["SPDX-License-Identifier: (MIT OR Apache-2.0)"]) == [["Apache-2.0-spdx", "MIT-spdx"]]
