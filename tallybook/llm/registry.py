"""The queries of this package and, where SQL can express them, their DuckDB counterparts."""

from tallybook.llm import anisotropic_search, bagminhash, curriculum, drift_clustering, fill_in_middle, language_crf, lattice_dedup, license_scan, line_dedup, packing, sentencepieces, suffix_dedup, url_filter

QUERIES = {
    "op1_license_diagonals": license_scan.op1_license_diagonals,
    "op2_language_crf": language_crf.op2_language_crf,
    "op3_bag_minhash": bagminhash.op3_bag_minhash,
    "op4_anisotropic_search": anisotropic_search.op4_anisotropic_search,
    "op5_line_hashing": line_dedup.op5_line_hashing,
    "op6_lattice_dedup": lattice_dedup.op6_lattice_dedup,
    "op7_url_vocabulary": url_filter.op7_url_vocabulary,
    "op8_island_packing": packing.op8_island_packing,
    "op9_deep_shallow": suffix_dedup.op9_deep_shallow,
    "op10_curriculum_mix": curriculum.op10_curriculum_mix,
    "op11_drift_clustering": drift_clustering.op11_drift_clustering,
    "op12_piece_agenda": sentencepieces.op12_piece_agenda,
    "op13_chunk_middle": fill_in_middle.op13_chunk_middle,
}
ORACLE_SQL = {
    "op1_license_diagonals": license_scan.ORACLE,
    "op5_line_hashing": line_dedup.ORACLE,
    "op6_lattice_dedup": lattice_dedup.ORACLE,
    "op7_url_vocabulary": url_filter.ORACLE,
    "op10_curriculum_mix": curriculum.ORACLE,
    "op11_drift_clustering": drift_clustering.ORACLE,
    "op13_chunk_middle": fill_in_middle.ORACLE,
}
