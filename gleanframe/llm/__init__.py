"""Training-data operators: ten building blocks for corpus pipelines.

Nothing outside this folder imports it; the repository works without it.
"""
