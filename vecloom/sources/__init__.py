from vecloom.sources.files import read_files, stream_files
from vecloom.sources.images import read_images, split_invalid
from vecloom.sources.tables import read_features, write_features

__all__ = [
    "read_features", "read_files", "read_images", "split_invalid", "stream_files", "write_features",
]
