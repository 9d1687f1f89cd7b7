from clickloom.plans.training import (
    fit_recommender,
    fit_recommender_by_id,
    fit_segments,
    fit_transaction_predictor,
    train_all,
)

__all__ = ["fit_recommender", "fit_recommender_by_id", "fit_segments", "fit_transaction_predictor", "train_all"]
