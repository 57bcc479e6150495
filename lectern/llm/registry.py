"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, decontaminate, embeddings, html, lines, minhash, pii, quality, token_counts, urls

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_urls": urls.op2_urls,
    "op3_html": html.op3_html,
    "op4_embeddings": embeddings.op4_embeddings,
    "op5_minhash": minhash.op5_minhash,
    "op6_lines": lines.op6_lines,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_bpe": bpe.op8_bpe,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_pii": pii.op10_pii,
}

ORACLE_SQL = {
    "op2_urls": urls.OP2_SQL,
    "op4_embeddings": embeddings.OP4_SQL,
    "op5_minhash": minhash.OP5_SQL,
    "op6_lines": lines.OP6_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
}
