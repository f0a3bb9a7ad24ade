import pytest
from pyspark.sql import functions as F

from tracemill.llm import langid

SENTENCES = {
    "en": ["The agent opened the first window and saved the file.", "There are many reasons why this should not happen again."],
    "de": ["Der Agent hat das erste Fenster geöffnet und die Datei gespeichert.", "Es gibt viele Gründe, warum das nicht wieder passieren sollte."],
    "fr": ["L'agent a ouvert la première fenêtre et il a enregistré le fichier.", "Il y a beaucoup de raisons pour que cela ne se reproduise pas."],
    "es": ["El agente abrió la primera ventana y guardó el archivo.", "Hay muchas razones por las que esto no debe ocurrir de nuevo."],
    "ru": ["Агент открыл первое окно и сохранил файл на диске.", "Есть много причин, почему это не должно повториться."],
    "uk": ["Агент відкрив перше вікно і зберіг файл на диску.", "Є багато причин, чому це не повинно повторитися."],
    "zh": ["代理打开了第一个窗口并保存了文件。", "这件事不应该再次发生，有很多原因。"],
    "ja": ["エージェントは最初のウィンドウを開いてファイルを保存しました。", "これが再び起こってはならない理由はたくさんあります。"],
    "hi": ["एजेंट ने पहली खिड़की खोली और फ़ाइल को सहेजा।", "ऐसा दोबारा नहीं होना चाहिए, इसके कई कारण हैं।"],
}


def test_labels(spark):
    rows = [("EN",), (" en ",), ("pt-BR",), ("zh_Hans",), ("ger",), ("Ukrainian",), ("und",), ("N/A",), ("??",), ("",), (None,), ("unknown",), ("Klingon",)]
    got = [r[0] for r in spark.createDataFrame(rows, "l string").select(langid.canonical_label(F.col("l"))).collect()]
    assert got == ["en", "en", "pt", "zh", "de", "uk", None, None, None, None, None, None, "other"]


def test_no_sentences():
    for t in ["", "  ", "click(x=1, y=2)\ndrag(3, 4)", "[12:33:01] 0xab12 47%", "```\nthe code is not a sentence here\n```", "/home/agent/a/b.xlsx", '{"a": [1, null], "b": {"c": true}}', "-----", "Playwell", "é½ﬁ→Ⅷ é ﬁ"]:
        assert langid.segments(t) == [], t


def test_seeds_alone_tell_the_languages():
    p = langid.Profiles(langid.train_prototypes([], []))
    for lang, texts in SENTENCES.items():
        for t in texts:
            assert [x[2] for x in langid.label_segments(p, t)] == [lang], t


def test_numbers_in_unspaced_sentences():
    p = langid.Profiles(langid.train_prototypes([], []))
    for lang, t in [("ja", "まだ179行が残っています。"), ("zh", "这里还有179行没有处理完。"), ("ja", "次にrow_12を開いて保存しました。"), ("zh", "我们把v2版本的文件保存到了这里。")]:
        assert [x[:3] for x in langid.label_segments(p, t)] == [(0, len(t), lang)], t
    assert langid.segments("まだ179行が残っています。")[0][2] == "まだ 行が残っています" and langid.segments("次にrow_12を開いて保存しました。")[0][2] == "次に を開いて保存しました"


def test_held_out_accuracy_and_wrong_labels(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    odd = docs.filter("doc_id % 2 = 1")
    protos = langid.train(odd)
    held = docs.filter("doc_id % 2 = 0").withColumn("label", langid.canonical_label(F.col("lang"))).filter("label in ('zh','ja','hi','ru','uk')")
    found = langid.identify(held, protos, "doc_id", "text", "label").filter("size(segments) > 0")
    # of these labels most are right, so nearly all texts must agree with them
    agree = found.select(F.avg((langid.languages()[0] == F.col("label")).cast("int"))).first()[0]
    assert agree > 0.75


HELD_OUT = {
    "en": ["I could not find the menu entry, so I searched for it.", "Please check whether the printer is connected.", "The report was sent yesterday evening.", "Nobody had closed the browser before lunch.", "We then compare both columns and remove the empty cells.", "Scroll down until the last picture appears."],
    "de": ["Ich konnte den Menüeintrag nicht finden und habe danach gesucht.", "Bitte prüfen Sie, ob der Drucker angeschlossen ist.", "Der Bericht wurde gestern Abend verschickt.", "Niemand hatte vor dem Mittagessen den Browser geschlossen.", "Dann vergleichen wir beide Spalten und entfernen die leeren Zellen.", "Blättere nach unten, bis das letzte Bild erscheint."],
    "nl": ["Ik kon het menu-item niet vinden, dus heb ik ernaar gezocht.", "Controleer of de printer is aangesloten.", "Het verslag is gisteravond verstuurd.", "Niemand had voor de lunch de browser gesloten.", "Daarna vergelijken we beide kolommen en verwijderen we de lege cellen.", "Blader naar beneden tot de laatste afbeelding verschijnt."],
    "fr": ["Je n'ai pas trouvé l'entrée du menu, alors je l'ai cherchée.", "Veuillez vérifier si l'imprimante est branchée.", "Le rapport a été envoyé hier soir.", "Personne n'avait fermé le navigateur avant le déjeuner.", "Nous comparons ensuite les deux colonnes et supprimons les cellules vides.", "Faites défiler jusqu'à ce que la dernière image apparaisse."],
    "es": ["No pude encontrar la opción del menú, así que la busqué.", "Compruebe si la impresora está conectada.", "El informe se envió ayer por la tarde.", "Nadie había cerrado el navegador antes del almuerzo.", "Después comparamos las dos columnas y eliminamos las celdas vacías.", "Desplázate hacia abajo hasta que aparezca la última imagen."],
    "pt": ["Não consegui encontrar a opção do menu, então procurei por ela.", "Verifique se a impressora está ligada.", "O relatório foi enviado ontem à noite.", "Ninguém tinha fechado o navegador antes do almoço.", "Depois comparamos as duas colunas e removemos as células vazias.", "Role para baixo até que a última imagem apareça."],
    "it": ["Non sono riuscito a trovare la voce del menu, quindi l'ho cercata.", "Controlla se la stampante è collegata.", "Il rapporto è stato inviato ieri sera.", "Nessuno aveva chiuso il browser prima di pranzo.", "Poi confrontiamo le due colonne e togliamo le celle vuote.", "Scorri verso il basso finché non appare l'ultima immagine."],
}


def test_held_out_sentences_of_the_latin_scripts(spark):
    protos = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    p = langid.Profiles(protos)
    got = [(lang, p.classify([langid.clean(t)])[0][0]) for lang, texts in HELD_OUT.items() for t in texts]
    right = sum(langid.CODES[k] == lang for lang, k in got)
    assert right >= 0.95 * len(got)


def test_training_reads_whole_texts():
    one, other = "Qaxi bevu dolmi fane.", "Zutto gimbe rasla poke."
    long = " ".join(f"{one[:-1]} {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}x." for k in range(5000)) + f" {other}"
    assert len(langid.segments(long)) == 5001
    whole, short = (langid.train_prototypes([t], ["nl"], rounds=0) for t in (long, long.removesuffix(other)))
    assert (whole[langid.CODES.index("nl")] != short[langid.CODES.index("nl")]).any()  # the last sentence counts as well


def test_run_numbers_start_anew_without_a_change(monkeypatch):
    protos = langid.train_prototypes([], [])
    texts = [t for ts in SENTENCES.values() for t in ts]
    want = langid.label_texts(langid.Profiles(protos), texts)
    monkeypatch.setattr(langid.Slots, "full", lambda self: True)
    monkeypatch.setattr(langid, "KEPT", 1)
    p = langid.Profiles(protos)
    assert [langid.label_texts(p, [t])[0] for t in texts] == want


def test_mixed_nulls_and_clashing_columns(spark):
    rows = [(1, SENTENCES["en"][0] + " " + SENTENCES["ru"][0] + "\n> " + SENTENCES["zh"][0], "en"), (2, None, "en"), (3, "   ", None), (4, SENTENCES["de"][0] * 3000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, segments string")
    out = {r.doc_id: r for r in langid.identify(df, langid.train_prototypes([], [])).withColumn("langs", langid.languages()).withColumn("m", langid.main_language()).collect()}
    assert out[1].langs == ["en", "ru", "zh"] and out[2].langs == [] and out[3].langs == [] and out[2].m is None
    assert out[4].m.lang == "de" and 1 / 12 < out[4].m.confidence <= 1
    assert langid.identify(df.limit(0), langid.train_prototypes([], [])).count() == 0


def test_training_bound(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(SENTENCES["en"][0]).alias("text"), F.lit("en").alias("lang"))
    assert langid.sample(df, "doc_id", "text", "lang", 40).count() == 40
