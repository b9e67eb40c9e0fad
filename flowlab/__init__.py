"""Flow analytics on Spark: layers, profiles, features, models and their evaluation.

Import from the modules below. This file stays empty of imports because Python workers load it
before they run the numeric helpers, and need none of the rest.

``plans.layers``     raw, staging and business layers and the run that writes them
``plans.training``   training set, and predictions for unlabelled flows
``operators``        table operators        ``functions``  column expressions
``sources``          readers and writers    ``storage``    shared scratch space
"""
