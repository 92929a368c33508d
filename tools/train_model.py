"""Train the serving model that the scoring queries load, and time the search.

    python tools/train_model.py SF_DIR                     write wardstat/plans/serving_model.json
    python tools/train_model.py SF_DIR --time TREES        seconds a tree of the whole declared search
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: a point of the declared search space
PARAMS = {"maxIter": 100, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.9, "featureSubsetFraction": 0.9,
          "minInstancesPerNode": 2, "gamma": 0.1, "regAlpha": 0.01, "regLambda": 1.0}


def main() -> None:
    from wardstat.operators import boosting as B
    from wardstat.operators.features import state_vocabulary
    from wardstat.operators.search import propose
    from wardstat.plans import catalog
    from wardstat.plans import model as MD
    from wardstat.session import build_session

    sf = sys.argv[1]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    feats = catalog.features(spark, sf).checkpoint(eager=True)
    if "--time" in sys.argv:
        trees = int(sys.argv[sys.argv.index("--time") + 1])
        points = [{**p, "maxIter": trees} for p in propose(MD.SEARCH_SPACE, [], 50, MD.RANDOM_STATE)]
        train = MD.stratified_split(feats).filter("split = 'train'")
        names = MD.kept_features(train, MD.MODEL_FEATURES)
        data = MD.prepare(MD.with_weight(train, 1.0), names).persist()
        cuts = B.cut_points(data, names)
        t = time.time()
        MD.cross_validate(data, names, cuts, points)
        print(json.dumps({"models": 5 * len(points), "trees": trees, "seconds": round(time.time() - t, 1)}))
        return
    t = time.time()
    res = MD.train(spark, feats, fixed_params=PARAMS)
    vocabulary = {r["state_key"]: r["state_encoded"] for r in state_vocabulary(feats).collect()}
    out = {"name": MD.MODEL_NAME, "version": "1", "metrics": res.metrics, "best_params": res.best_params,
           "vocabulary": dict(sorted(vocabulary.items())), "booster": json.loads(res.model.booster.to_json())}
    with open(MD.SERVING_MODEL, "w") as f:
        json.dump(out, f, separators=(",", ":"))
    print(json.dumps({"seconds": round(time.time() - t, 1), "metrics": res.metrics, "bytes": os.path.getsize(MD.SERVING_MODEL)}))


if __name__ == "__main__":
    main()
