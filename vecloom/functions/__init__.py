from vecloom.functions.columns import (
    dense_vector, label_from_path, label_from_uri, long_form, unit_hash,
)

__all__ = ["dense_vector", "label_from_path", "label_from_uri", "long_form", "unit_hash"]
