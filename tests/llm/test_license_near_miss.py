"""op10: a notice's neighbours do not get its label; real notices get their own."""

import textwrap

from vidgraph.llm import licenses

NEAR = [
    ("Licensed under CC BY 4.0", ["cc-by-4.0"]),
    ("Licensed under CC BY-SA 4.0", ["cc-by-sa-4.0"]),
    ("Licensed under CC BY-NC-SA 4.0", ["cc-by-nc-sa-4.0"]),
    ("Licensed under CC BY-NC 4.0", ["cc-by-nc-4.0"]),
    ("Licensed under the Eclipse License, Version 2.0", []),
    ("Licensed under the Apache License, Version 1.1", []),
    ("Released under the BSD License", []),
    ("This work is licensed under the GNU General Public License, version 2", []),
    ("This work is licensed under the GNU Lesser General Public License, version 3", []),
    ("This work is licensed under the GNU General Public License, version 3", ["gpl-3.0"]),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license", []),
    ("license, mit: released under the", []),
]


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r["template_labels"] for r in licenses.scan_licenses(docs).collect()}


def test_near_misses(spark):
    out = labels(spark, [t for t, _ in NEAR] + [f"words before\n{t}\nand after" for t, _ in NEAR])
    for i, (text, expected) in enumerate(NEAR * 2):
        assert out[i] == expected, text


def test_every_notice_has_its_label(spark):
    notices = {**licenses.TEMPLATES, **licenses.NOTICES}
    assert licenses.REQUIRED.keys() <= notices.keys()
    out = labels(spark, ["\n".join(f"# {x}" for x in textwrap.wrap(t, 60)) for t in notices.values()])
    for i, name in enumerate(notices):
        assert name in out[i], (name, out[i])
    families = {"gpl": "gpl", "agpl": "agpl", "lgpl": "lgpl", "isc": "isc", "mpl": "mpl", "cc": "cc", "mit": "mit"}
    for i, name in enumerate(notices):
        family = name.split("-")[0]
        if family in families:
            assert all(x.split("-")[0] == family for x in out[i]), (name, out[i])
