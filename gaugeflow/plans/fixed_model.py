"""A model with written-down coefficients, so that scores can be checked in SQL."""

from gaugeflow.operators.model import LinearScore

# Fixed values, near those of a model trained on the event records.
FIXED = LinearScore(
    coefficients=(
        # cat0 .. cat7
        *(-1.7645, 0.0, 0.0, 0.0, 1.9728, 0.0, 0.0, 0.0),
        # sensor0 .. sensor9
        *(0.0934, 0.0726, 0.0276, 0.0273, 0.0192, 0.0178, 0.0174, 0.0125, 0.0095, 0.0112),
    ),
    intercept=-3.9913,
)
