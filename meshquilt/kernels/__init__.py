"""NumPy kernels that run one model at a time inside Arrow group functions."""
