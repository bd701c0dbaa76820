from casegrid.plans.analyses import (
    community_rates,
    income_correlations,
    method_frequency,
    nearest_station,
    victims_by_age,
    victims_by_descent,
)

__all__ = [
    "community_rates",
    "income_correlations",
    "method_frequency",
    "nearest_station",
    "victims_by_age",
    "victims_by_descent",
]
