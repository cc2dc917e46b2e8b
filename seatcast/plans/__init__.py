"""Compositions of operators: the training / serving pipelines and the
registered query catalog."""
