"""Task balance of the trending window stage, from Spark's event log (written to a scratch folder;
the UI stays off): the (article, day-block) plan against the same plan partitioned by article alone.

usage: python tools/skew_report.py [event_log_dir]      (a fresh folder, e.g. from mktemp -d)
"""
import glob
import json
import os
import statistics
import sys
import tempfile
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F, Window
from viewtide.session import local_session
from viewtide.operators import windows as win
from viewtide.sources.tables import read_requests
logdir = sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="viewtide-evlog-")
spark = local_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
                             "spark.sql.adaptive.coalescePartitions.enabled": "false",
                             "spark.sql.shuffle.partitions": "32"})
sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
req = read_requests(spark, sf)

def naive(df, slots=6, width=10):
    m = win.bucket_counts(df, 60).repartition("article")
    c = (m.select("article", "views", F.explode(F.sequence(F.col("b") - (width - 1), F.col("b"))).alias("s"))
          .groupBy("article", "s").agg(F.sum("views").alias("c")))
    w = Window.partitionBy("article").orderBy("s")
    later = [F.max("c").over(w.rangeBetween(k * width, k * width)).alias(f"s{k}") for k in range(1, slots)]
    out = c.select("article", "s", F.col("c").alias("s0"), *later)
    names = [f"s{i}" for i in range(slots)]
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return out.where(cond & win.non_decreasing(names))

for label, df in (("blocked", win.trending(req)), ("by_article", naive(req))):
    spark.sparkContext.setJobGroup(label, label)
    for _ in range(2):
        df.write.format("noop").mode("overwrite").save()
    print(label, "rows", df.count())
spark.stop()
# parse the event log: task durations per stage, last run of each label
f = sorted(glob.glob(logdir + "/*"))[-1]
stages, group_of_stage, tasks = {}, {}, {}
job_group = {}
for line in open(f):
    ev = json.loads(line)
    e = ev["Event"]
    if e == "SparkListenerJobStart":
        g = ev.get("Properties", {}).get("spark.jobGroup.id")
        for st in ev["Stage IDs"]:
            group_of_stage[st] = g
    elif e == "SparkListenerTaskEnd":
        st = ev["Stage ID"]; info = ev["Task Info"]
        tasks.setdefault(st, []).append((info["Finish Time"] - info["Launch Time"],
                                          ev.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)))
for g in ("blocked", "by_article"):
    sts = [s for s in tasks if group_of_stage.get(s) == g and len(tasks[s]) > 1]
    # the stage with the most shuffle records read per task is the window stage
    best = max(sts, key=lambda s: max(r for _, r in tasks[s]))
    recs = [r for _, r in tasks[best]]; durs = [d for d, _ in tasks[best]]
    busy = [r for r in recs if r > 0]
    print(g, "stage", best, "tasks", len(recs), "non-empty", len(busy), "max records/task", max(recs),
          "median(non-empty)", int(statistics.median(busy)), "max ms", max(durs))
