"""``python -m docsieve folder -n corpus``: a session over a folder of documents.

``train``, ``test`` and ``stopwords`` as the first word make and try resources instead."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from docsieve.plans import session


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("docsieve").getOrCreate()


def train(argv: list[str]) -> None:
    """A Bayes model of lines ``label<TAB>text``."""
    from docsieve.operators import bayes
    from docsieve.sources import corpus, sinks

    p = argparse.ArgumentParser(prog="docsieve train", description=train.__doc__)
    p.add_argument("lines")
    p.add_argument("-o", "--output", required=True, help="folder of the model's table")
    p.add_argument("-t", "--training", default="entry", help="name of the training")
    a = p.parse_args(argv)
    sinks.save_model(bayes.train(corpus.training_lines(_spark(), a.lines), a.training), a.output)


def test(argv: list[str]) -> None:
    """What a model says of lines ``label<TAB>text``, as ``label;code;probability``, and how often it is right."""
    from docsieve.operators import bayes
    from docsieve.sources import corpus, sinks

    p = argparse.ArgumentParser(prog="docsieve test", description=test.__doc__)
    p.add_argument("lines")
    p.add_argument("-m", "--model", required=True)
    p.add_argument("-o", "--output", required=True, help="folder of the lines")
    p.add_argument("-t", "--training", default="entry")
    a = p.parse_args(argv)
    spark = _spark()
    sinks.write_guesses(bayes.try_out(corpus.training_lines(spark, a.lines), spark.read.parquet(a.model), a.training), a.output)
    back = spark.read.schema("label string, code string, probability double").option("sep", ";").csv(a.output)
    right, n = back.selectExpr("count_if(label = code)", "count(*)").first()
    print(f"{right} of {n}")


def stopwords(argv: list[str]) -> None:
    """A stop-word table of a list of words, a word a line."""
    from docsieve.sources import sinks

    p = argparse.ArgumentParser(prog="docsieve stopwords", description=stopwords.__doc__)
    p.add_argument("words")
    p.add_argument("-o", "--output", required=True, help="folder of the table")
    p.add_argument("--lexicon")
    p.add_argument("--lemmas")
    a = p.parse_args(argv)
    spark = _spark()
    files = tuple((k, v) for k, v in (("lexicon", a.lexicon), ("lemmas", a.lemmas)) if v)
    config = session.load_resources(spark, session.SessionConfig("words", a.words, resource_files=files))
    sinks.stop_words(spark.read.text(a.words), config.resources).write.mode("overwrite").parquet(a.output)


COMMANDS = {"train": train, "test": test, "stopwords": stopwords}


def main(argv: list[str]) -> None:
    if argv and argv[0] in COMMANDS:
        COMMANDS[argv[0]](argv[1:])
        return
    given = session.parser().parse_args(argv)
    if given.list:
        print("\n".join(session.list_stages()))
        return
    config = session.parse(argv)
    spark = _spark()
    if given.model:
        config = replace(config, bayes_model=spark.read.parquet(given.model))
    for folder in session.launch(spark, config):
        print(folder)
        if not given.quiet and set(config.stages) & set(session.FINISH):
            for r in session.progress(spark.read.parquet(f"{folder}/records"), config).collect():
                print(f"  {r.stage}: {r.treated} of {r.records}")


if __name__ == "__main__":
    main(sys.argv[1:])
