"""Run parameters (section 1.4 of the survey) as one dataclass.

The original reads environment variables over INI values over code defaults;
here every setting is a keyword argument. ``from_ini`` reads an INI file of the
same layout for users who keep one.
"""

from __future__ import annotations

import configparser
import datetime as _dt
from dataclasses import dataclass, field, fields


def parse_day(value) -> _dt.date:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` (or a date) as a date."""
    if isinstance(value, _dt.date):
        return value
    t = str(value).strip().replace("-", "")
    return _dt.date(int(t[:4]), int(t[4:6]), int(t[6:8]))


@dataclass
class Params:
    # recall
    label_date: _dt.date = _dt.date(2014, 12, 18)
    max_per_user: int | None = None        # the original: 200
    enable_hot_backfill: bool = False
    hot_top: int = 50                      # read only with enable_hot_backfill
    align_recall: bool = True
    pos_filter_in_recall: bool = True
    dedupe_items: bool = False
    # sampling / training
    downsample_neg: bool = True
    neg_pos_ratio: float = 20
    neg_max_gap_days: int | None = None
    bucketed_neg: bool = True
    recency_bounds: tuple = (1, 3, 7)
    use_group_kfold: bool = True
    n_splits: int = 3
    balanced_folds: bool = False           # users dealt to folds by size, else by hash
    early_stopping: int = 200              # rounds without a better AUC that end a fold's training, 0 never
    fast_params: bool = True
    max_iter: int | None = None
    exclude_features: tuple = ()
    drop_time_gap_features: bool = False
    seed: int = 42
    # strategy
    force_strategy: str = ""
    strong_only: bool = False
    min_prob: float | None = None
    topn: int | None = None
    max_submission: int = 0                # 0: all
    cart_max_rows: int = 0                 # 0: all
    exclude_day_purchases: str | None = None
    topk_k: int = 5
    topk_m: int = 2
    cart_days_max: int = 3
    eval_cart_days_max: int = 1
    threshold: float = 0.5
    threshold_min_rows: int = 0            # fewer picks fall back to two-stage; the original: 1000
    # evaluation
    eval_strategy: bool = True
    eval_sample_user_frac: float | None = None   # None: all users; the original: 0.02
    eval_sample_floor: int = 0                   # the original: 20000
    val_full: bool = False
    # embedding
    feature_viz: bool = False
    viz_only: bool = False
    viz_sample_per_class: int = 10000      # rows of a class in the plot's sample
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_ini(cls, path: str, **overrides) -> "Params":
        cfg = configparser.ConfigParser()
        cfg.read(path)
        p = cls()
        flat = {k: v for sec in cfg.sections() for k, v in cfg[sec].items()}
        for k, v in flat.items():
            p.set_text(k, v)
        for k, v in overrides.items():
            setattr(p, k, v)
        return p

    def set_text(self, key: str, text: str) -> None:
        """Sets one parameter from text, by the type its field declares; a key
        that no field has is kept in ``extra``."""
        text = text.strip()
        kind = {f.name: str(f.type) for f in fields(self) if f.name != "extra"}.get(key)
        if kind is None:
            self.extra[key] = text
        elif key == "label_date":
            self.label_date = parse_day(text)
        elif kind == "tuple":
            items = [x.strip() for x in text.split(",") if x.strip()]
            setattr(self, key, tuple(int(x) if x.lstrip("-").isdigit() else x for x in items))
        elif kind == "bool":
            setattr(self, key, text.lower() in ("1", "true", "yes", "on"))
        elif key == "exclude_day_purchases":
            self.exclude_day_purchases = None if text in ("", "0") else text
        elif "None" in kind and not text:
            setattr(self, key, None)
        elif kind.startswith("int"):
            setattr(self, key, int(float(text)))
        elif kind.startswith("float"):
            setattr(self, key, float(text))
        else:
            setattr(self, key, text)
        if key == "max_submission":            # the cap also bounds the cart picks; 0 means all
            self.cart_max_rows = self.max_submission
        elif key == "cart_days_max":
            self.eval_cart_days_max = self.cart_days_max
