"""Business marts: compositions of the operators, each a lazy plan."""

from motorledger.plans import (
    accessories,
    app,
    costs,
    dashboard,
    film,
    finance,
    jobs,
    orders,
    products,
    sales,
    scores,
    stock,
)

__all__ = [
    "accessories", "app", "costs", "dashboard", "film", "finance", "jobs",
    "orders", "products", "sales", "scores", "stock",
]
