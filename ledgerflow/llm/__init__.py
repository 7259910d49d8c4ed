"""Training-data operators: counting tokens, removing copies, judging quality, scoring with a
language model, decontaminating and mixing. Nothing else in the library imports this package.

Functions that run in Python workers are pickled by value, so executors need only numpy, pyarrow
and the libraries an operator names, not an installed copy of this package."""

from ledgerflow.session import ship_with_tasks

ship_with_tasks(__name__)
