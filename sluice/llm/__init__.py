"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

One module per operator: ``simhash`` (1), ``covertree`` (2), ``topk`` (3), ``quality`` (4), ``linechunks`` (5),
``rans`` (6), ``toxicity`` (7), ``langid`` (8), ``pieces`` (9), ``packing`` (10), ``exactcopies`` (11),
``merkle`` (12), ``periodic`` (13).  Shared: ``components`` (connected components),
``textcols`` (Arrow text columns), ``wordbpe`` (tokenizer files), ``staging`` (scratch tables), ``queries`` (registered queries).
"""
