from .cells import stream_cells
from .rollup import histogram_quantile, merge_histograms, retrieval_histogram, retrieval_rollup
