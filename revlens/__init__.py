"""revlens: review analytics on Spark DataFrames.

Two jobs built from composable DataFrame operators:

* item recommendation with ALS (dense ids, persona user, candidate set,
  ranked report, grid search), in :mod:`revlens.plans.recommend` and
  :mod:`revlens.plans.tune`;
* review sentiment with key n-grams and a linear SVM, in
  :mod:`revlens.plans.keyphrase` and :mod:`revlens.plans.sentiment`.

Every operator takes and returns DataFrames; no operator collects
data-sized results to the driver or evaluates row-at-a-time Python.
"""

__version__ = "0.1.0"
