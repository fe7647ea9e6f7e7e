"""The registered queries of this subpackage and the SQL that states them, where SQL can."""

from __future__ import annotations

from . import ann, embeddings, lines, manifest, merkle, minhash, mixing, packing, periods, quality, secrets, suffix, warc


def queries() -> dict:
    return {
        "op1_line_dedup": lines.op1,
        "op2_embedding_dedup": embeddings.op2,
        "op3_warc": warc.op3,
        "op4_secrets": secrets.op4,
        "op5_suffix_dedup": suffix.op5,
        "op6_mixing": mixing.op6,
        "op7_packing": packing.op7,
        "op8_quality": quality.op8,
        "op9_merkle": merkle.op9,
        "op10_minhash_dedup": minhash.op10,
        "op11_periodic_runs": periods.op11,
        "op12_graph_ann": ann.op12,
        "op13_merkle_manifest": manifest.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": warc.OP3_SQL, "op13_merkle_manifest": manifest.OP13_SQL}
