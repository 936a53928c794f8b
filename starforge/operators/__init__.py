"""DataFrame operators: shaping, null policies, dedup, keys, lookups, set
operations, product-map inference and audits."""

from starforge.operators.audit import ParseAudit, observe_rows, row_count
from starforge.operators.dedup import (attach_contract_span, contract_span,
                                       distinct_rows, drop_duplicates_all,
                                       keep_one)
from starforge.operators.hot_keys import hot_keys, known_large, lookup_split
from starforge.operators.inference import (cooccurrence_pairs_per_client,
                                           infer_product_map)
from starforge.operators.keys import (ROW_ID, dense_key, identity_of, surrogate_key,
                                     total_order, with_row_identity)
from starforge.operators.lookup import (broadcast_if_small, enrich, lookup,
                                        rejects, require_in, role_join)
from starforge.operators.nulls import fill_missing_score, fill_unknown, fill_zero
from starforge.operators.reasons import Checked, Lookup, lookup_with_reasons, split_by_reasons
from starforge.operators.registry import (new_keys, unseen,
                                          with_registered_keys)
from starforge.operators.setops import observed_dates, union_by_name
from starforge.operators.shaping import (col, null_col, rename_project,
                                         replace_column, tag, to_gold_names)

__all__ = [
    "Checked", "Lookup", "ParseAudit", "lookup_with_reasons", "split_by_reasons",
    "ROW_ID", "identity_of", "with_row_identity",
    "attach_contract_span", "broadcast_if_small", "col", "contract_span",
    "cooccurrence_pairs_per_client", "dense_key", "distinct_rows",
    "drop_duplicates_all", "enrich", "fill_missing_score", "fill_unknown",
    "fill_zero", "hot_keys", "infer_product_map", "keep_one", "known_large", "lookup", "lookup_split", "new_keys",
    "null_col",
    "observe_rows", "observed_dates", "rejects", "rename_project",
    "replace_column", "require_in", "role_join", "row_count", "surrogate_key",
    "tag", "to_gold_names", "total_order", "union_by_name", "unseen",
    "with_registered_keys",
]
