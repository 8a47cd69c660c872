"""Executed plans: what scans have read."""


def nodes(plan):
    """The nodes of an executed plan, those inside query stages too."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    else:
        yield plan
        below = plan.children()
        for i in range(below.size()):
            yield from nodes(below.apply(i))


def scan_metric(df, name: str, column: str) -> int:
    """The sum of a metric over the scans that read a column; the same DataFrame must have been collected."""
    out = 0
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.getClass().getSimpleName() == "FileSourceScanExec" and f"{column}#" in node.output().toString():
            out += node.metrics().get(name).get().value()
    return out


def text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
