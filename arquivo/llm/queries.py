"""The registered queries of this subpackage and the DuckDB SQL of those it can express."""

from __future__ import annotations

from arquivo.llm import chat, clustering, decontam, langid, lines, packing, quality, simhash, spelling, substrings, tokens, toxicity, warc

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_chat": chat.op2_chat,
    "op3_quality": quality.op3_quality,
    "op4_decontam": decontam.op4_decontam,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_tokens": tokens.op6_tokens,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_langid": langid.op8_langid,
    "op9_packing": packing.op9_packing,
    "op10_warc": warc.op10_warc,
    "op11_spelling": spelling.op11_spelling,
    "op12_substrings": substrings.op12_substrings,
    "op13_centroids": clustering.op13_centroids,
}

ORACLES: dict[str, str] = {
    "op2_chat": chat.ORACLE,
    "op4_decontam": decontam.ORACLE,
    "op10_warc": warc.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op12_substrings": substrings.ORACLE,
    "op13_centroids": clustering.ORACLE,
}
