"""Licenses that are wrapped over lines."""

from kinweave.llm import licenses

BSD = ["Redistribution and use in source and binary forms, with or without modification,", "are permitted provided that the following conditions are met"]
ISC = ["Permission to use, copy, modify, and/or distribute this software for any purpose", "with or without fee is hereby granted"]


def test_wrapped_licenses_are_found(spark):
    filler = "lorem ipsum dolor sit amet the public of this and that"
    texts = [
        "\n".join(BSD),
        "\n".join([filler, *ISC, filler]),
        "\n".join(f" * {x}" for x in ["Copyright", *BSD, "", *ISC]),
        "\n".join(licenses.TEMPLATES["MIT"][1].split()),
        f"{filler} Released under\nthe MIT License. {filler}",
        "\n".join([licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["CC0"][1]]),
        "Redistribution of the\nsource and the forms of\nuse, with or without a permit",
        "\n".join([*BSD, *[filler] * 3, *BSD]),
        "\n".join([filler] * 3),
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.paragraphs for x in licenses.report(table).collect()}
    assert [got[i] for i in range(9)] == ["0:BSD", "1:ISC", "1:BSD,4:ISC", "0:MIT", "0:MIT", "0:MIT,1:CC0", "", "0:BSD,5:BSD", ""]
