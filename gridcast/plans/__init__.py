"""Multi-step plans: the tick fold, its tiled form, and serving."""
