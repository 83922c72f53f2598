"""Composed personal items and sentences around them: the labelled spans that the tagger is trained on.

Items are built from short lists of common European names and street words, from names invented letter by letter after
these lists, and from the public layouts of telephone, identity and postal numbers.  A composed text is a few plain
sentences of real documents with one or more frames between them; every item's place is known because it was put there.
Some frames hold look-alikes (references, readings, handles, streets without a number), which are not items.  Half of
the texts around items are random words of public tokenizer vocabularies instead of frames, so that an item must be
told by itself and not by the sentence it usually stands in.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

# Common given names and surnames by language.
GIVEN = {
    "en": "James Emma William Olivia George Amelia Thomas Sarah Daniel Rachel Andrew Laura Peter Susan Michael Karen Simon Helen Kevin Joan Brian Ruth Philip Janet Victor Hazel Owen Megan Neil Gwen".split(),
    "fr": "Camille Louis Manon Antoine Nathalie François Céline Sébastien Margaux Gérard Solène Thierry Élodie Pascal Aurélie Yves Noémie Didier Inès Hervé Marie-Claude Jean-Pierre Anne-Sophie Zoé Gaël Maël Léa Théo Chloé Loïc".split(),
    "de": "Anna Stefan Petra Wolfgang Heike Günter Birgit Thorsten Ursula Rainer Monika Jörg Silke Bernd Renate Matthias Gisela Holger Ute Friedrich Hans-Peter Eva-Maria Sören Käthe Götz Kai Doris Volker Elke Ralf".split(),
    "es": "Carlos Ana Miguel Elena Antonio Teresa Manuel Isabel Francisco Marta Jorge Cristina Sergio Beatriz Andrés Inés Raúl Sofía Joaquín Mónica Ramón Verónica Ángel Nuria Óscar Begoña Iván Noelia Adrián Belén".split(),
    "it": "Giuseppe Francesca Antonio Paola Giovanni Elisa Roberto Silvia Stefano Federica Andrea Valentina Davide Alessandra Simone Ilaria Fabio Serena Massimo Nicoletta Niccolò Pierluigi Annamaria Edoardo Bruna Tommaso Rosanna Cesare Luisa Aldo".split(),
    "xx": "Agnieszka Piotr Katarzyna Tomasz Łukasz Małgorzata Jan Pieter Marieke Willem Sanne Lars Astrid Björn Sigrid Østein Søren Zoltán Ágnes Ioana Mihai Ana-Maria Nikos Eleni Mehmet Ayşe Željko Jelena Ondřej Zuzana".split(),
}
SURNAMES = {
    "en": "Taylor Walker Hughes Bennett Cooper Fletcher Marsh Hawkins Ellison Whitaker Radcliffe Pemberton Stokes Barlow Hayes Thornton Langford Ashby Kingsley Dalton Prescott Holloway Merrick Wainwright Blackwood O'Connor McKenzie Fitzgerald Atkins Chapman".split(),
    "fr": "Martinez Lefebvre Moreau Girard Fontaine Chevalier Rousselot Perrault Gauthier Lambert Delacroix Marchand Vasseur Boucher Renard Bertin Collet Meunier Faivre Guichard Lacroix D'Aubigny Le-Goff Poulain Texier Aubert Bonnard Cordier Desmoulins Évrard".split(),
    "de": "Schneider Wagner Hoffmann Krüger Zimmermann Lehmann Schröder Köhler Baumgartner Vogel Neumann Schwarz Brandt Lindner Kirsch Ziegler Weiß Böhm Seidel Pfeiffer Winkler Rößler Haas Dietrich Ackermann Steinbach Voigt Kuhn Engel Reuter".split(),
    "es": "García Fernández Navarro Romero Torres Serrano Molina Castillo Ortega Vargas Cabrera Peña Herrera Iglesias Aguirre Mendoza Rivas Salazar Ibáñez Núñez Quintana Villalba Carrasco Montoya Espinosa Zamora Bermúdez Olmedo Pascual Rincón".split(),
    "it": "Ferrari Esposito Romano Colombo Ricci Marino Greco Conti De-Luca Mancini Barbieri Fontana Caruso Rinaldi Lombardi Moretti Gallo Leone Pellegrini Bellini Sartori Vitale Basile Fabbri Guerra D'Amico Monti Piras Salvi Zanetti".split(),
    "xx": "Kowalczyk Nowak Wiśniewska Dąbrowski de-Vries Jansen Bakker Visser Larsen Nilsson Hedlund Sørensen Kovács Horváth Popescu Ionescu Papadopoulos Yılmaz Petrović Novák Dvořáková Świątek Łuczak Lindqvist Bergström Hansen Tóth Marković Georgiou Kaya".split(),
}
PARTICLES = {"en": [""], "fr": ["", "de ", "du ", "Le ", "de La "], "de": ["", "von ", "von der "], "es": ["", "de ", "de la ", "del "], "it": ["", "Di ", "De ", "Della ", "Lo "], "xx": ["", "van der ", "van ", "ten "]}
# Words that streets are named with, and what stands before or after them.
STREET_NAMES = {
    "en": "Mill Church Park Station Elm Victoria Queens Meadow Bridge Willow Orchard Castle Manor School Green Highfield Spring North West Abbey Albert Beech Rose Kings Harbour Quarry Tannery Chapel Old New Upper Lower Long".split(),
    "fr": "Pasteur;Victor Hugo;Jean Jaurès;République;Moulin;Église;Fontaine;Gare;Lilas;Acacias;Marché;Château;Verger;Tilleuls;Remparts;Général Leclerc;Prés;Liberté;Lavoir;Four;Écluse;Alouettes;Vieux Puits;Carriers;Saint-Michel;Vieux-Pont".split(";"),
    "de": "Haupt Bahnhof Garten Schul Kirch Berg Linden Mozart Goethe Wald Wiesen Mühlen Ring Feld Rosen Birken Sonnen Brunnen Schiller Post Ufer Acker Schäfer Gerber Weber Alt Neu Kapellen Eichen Flieder".split(),
    "es": "Mayor;Sol;Olmo;Fuente;Iglesia;Constitución;Molino;Real;Castilla;Gran Vía;San Juan;Santa Ana;Pozo;Chopos;Naranjos;Libertad;Puente Viejo;Cervantes;Estación;Rosario;Mercado;Tejedores;Alameda".split(";"),
    "it": "Roma;Garibaldi;Mazzini;Verdi;Dante Alighieri;Mulino;Fontana;Stazione;Marconi;Cavour;San Marco;Santa Lucia;Vittorio Emanuele;Libertà;Pozzo;Gelsi;Chiesa;Castello;Repubblica;Tigli;Ponte Vecchio;Lavatoio".split(";"),
}
STREET_TYPES = {
    "en": "Street Road Lane Avenue Close Row Rise Way Drive Terrace Court Place Square Hill Walk Gardens Crescent Grove Mews Yard St Rd Ave Ln Dr Boulevard Parade Path".split(),
    "fr": "rue avenue boulevard chemin place quai impasse allée route cours square passage sentier av. bd bd. pl. imp. ruelle esplanade rond-point montée faubourg Rue Avenue Boulevard Place".split(),
    "de": "straße strasse str. weg platz gasse allee ring ufer damm steig markt hof stieg graben".split(),
    "es": "Calle C/ C. Avenida Avda. Av. Plaza Pza. Pl. Paseo P.º Camino Cno. Ronda Travesía Cuesta Carretera Callejón Glorieta calle avenida".split(),
    "it": "Via V. Viale V.le Corso C.so Piazza P.za Piazzale Largo L.go Vicolo Strada Contrada Vico Salita via".split(),
}
DE_LEADS = "Am;An der;An den;Im;In der;Zum;Zur;Auf der;Auf dem;Unter den;Hinter dem;Beim".split(";")
DE_PLACES = "Markt;Alten Markt;Mühle;Linden;Brunnen;Tor;Kirche;Neuen Wehr;Wald;Ufer;Alten Mühle;Graben;Oberen Feld;Hohen Stein;Teich;Anger;Schlossgarten;Kapelle;Weiher".split(";")
PLACES = "Lyon Madrid Torino Bad-Homburg Saint-Étienne Newcastle Kraków Bergen Santa-Cruz Villa-Nova Mont-Blanc Groß-Gerau San-Remo Le-Havre Nowa-Huta Oud-Beijerland".split()
DOMAINS = "example.org example.com post.example.net mail.invalid web.test box.test firma.example studio.example uni-nord.test mairie-ville.example comune.example kanzlei.example gmail.example".split()

# Frames: {P} person, {E} e-mail, {T} telephone, {I} identity number, {A} address; the rest is no item:
# {S} street without number, {L} place, {W} postcode and town, {N} number, {R} reference, {C} coordinates, {H} handle.
FRAMES = r"""
Please write to {P} before noon.|Our neighbour {P} keeps the second key.|{P} measured the weir near {L} again.|As {P} told us, the road is closed.|Mr {P} and Mrs {P} own the meadow.
Minutes taken by {P}, chaired by {P}.|The letter from Dr {P} arrived late.|Photo: {P}|Signed: {P}|Author: {P}, {N} pages|Thanks to {P} for the old map.|Kind regards,\n{P}\n{A}\n{W}|Best wishes\n{P}
Contact {P} ({E}) or call {T}.|You can reach me on {T} after six.|Tel: {T}, fax {T}|Ring {T} ext. {N} for the keeper.|Phone {T} (office hours only).|Mail {E} with your remarks.|Send the scans to <{E}>, please.|mailto:{E}
She lives at {A}, behind the church.|Deliver it to {A}, {W}.|Our office is at {A}.|The house at {A} was sold in {N}.|Insurance number {I} is on the form.|His passport {I} was checked.|SSN: {I}|National ID {I}, issued in {L}.|The card {I} was found near {S}.
We walked down {S} for {N} km.|Ticket {R} was closed.|The mast stands at {C}.|User {H} changed it.|Both {L} and {L} were flooded.|The {S} bridge is {N} m long.|Sheet {R} shows {L}.|The survey by the Royal Map Office covers {L}.|{S} and {S} meet in {L}.
Adressez-vous à {P}.|Mme {P} tient le registre depuis {N}.|M. {P} habite {A}.|D'après {P}, le gué est fermé.|Rédigé par {P} le 3 mai.|Bien à vous,\n{P}\n{T}|Vu avec {P} devant l'église de {L}.|Remis à {P} contre signature.|{P} a relevé la borne de {L}.|Merci à {P} pour la photo.
Téléphone : {T}|Joindre la mairie au {T} avant midi.|Écrire à {E} pour toute question.|Courriel : {E}|Son domicile est au {A}, {W}.|Le siège se trouve {A}.|Envoyer le colis : {A}, {W}.|Carte d'identité n° {I}|Numéro de sécurité sociale {I}, à vérifier.|Sous le numéro {I}.
La {S} descend vers {L}.|Dossier {R} clos.|Le point {C} est faux.|L'utilisateur {H} a corrigé.|De {L} à {L}, compter {N} km.|La commune de {L} a {N} habitants.|La parcelle {R} est au bord de la {S}.
Bitte an {P} wenden.|Herr {P} wohnt {A}.|Frau {P} hat den Plan gezeichnet.|Nach Angaben von {P} fehlt ein Stein.|Gezeichnet {P}|Mit freundlichen Grüßen\n{P}\n{A}\n{W}|Gemeldet hat es {P} aus {L}.|Gespräch mit {P} im Rathaus.|{P} unterschrieb das Blatt.|Viele Grüße, {P}
Telefon {T}, Fax {T}|Unter {T} ist niemand erreichbar.|Rufen Sie {T} an.|E-Mail: {E}|Schreiben Sie an {E}.|Lieferung an {A}, {W}.|Das Büro liegt jetzt {A}.|Er wohnt {A} neben dem Pegel.|Personalausweis {I}, gültig bis {N}.|Steuernummer {I}|Die Versichertennummer lautet {I}.
Die {S} führt nach {L}.|Vorgang {R} ist erledigt.|Der Mast steht bei {C}.|Benutzer {H} meldet das.|Zwischen {L} und {L} liegen {N} km.|Blatt {R} fehlt.|Der Gemeinderat von {L} tagt.
Hable con {P}.|Don {P} guarda la llave.|Doña {P} vive en {A}.|Según nos dijo {P}, no hay paso.|Firmado: {P}|Atentamente,\n{P}\n{A}\n{W}|Lo midió {P} cerca de {L}.|Aviso de {P}, vecino de {L}.|{P} firmó el acta.
Teléfono: {T}|Llame al {T} por la tarde.|Correo: {E}|Escriban a {E}.|Entregar en {A}, {W}.|La oficina está en {A}.|DNI {I}|Documento de identidad: {I}.|La tarjeta {I} caducó.
La {S} baja hasta {L}.|Expediente {R} cerrado.|El hito está en {C}.|El usuario {H} lo cambió.|De {L} a {L} hay {N} km.|El alcalde de {L} no vino.
Chiedere di {P}.|Il signor {P} abita in {A}.|La signora {P} ha la chiave.|Come dice {P}, il guado è chiuso.|Firmato {P}|Cordiali saluti,\n{P}\n{A}\n{W}|Rilievo di {P} presso {L}.|Visto con {P} in piazza.|{P} firmò il foglio.|A cura di {P}
Telefono: {T}|Chiami il {T} la mattina.|Posta: {E}|Scrivere a {E} per errori.|Consegna in {A}, {W}.|La sede è in {A}.|Codice fiscale {I}|Documento n. {I}, scaduto.|Tessera sanitaria {I}.
La {S} scende a {L}.|Pratica {R} chiusa.|Il punto {C} è sbagliato.|L'utente {H} lo corregge.|Da {L} a {L} sono {N} km.|Il comune di {L} ha {N} abitanti.
{"name": "{P}", "mail": "{E}", "tel": "{T}"}|{"addr": "{A}", "id": "{I}"}|{"id": "{I}", "who": "{P}"}|name={P};|mail={E};|tel={T};|addr={A};|id={I};|owner={P}; tel={T}; {N}|ref={R};|user={H};|pos={C};
<li>{P}</li><li>{T}</li>|<li>{I}</li><li>{A}</li>|<td>{P}</td><td>{E}</td>|* {P}\n* {T}|- {A}\n- {I}|- {E}|> {P}\n> {E}|> {A}\n> {T}|* {I}|({I})|({E})|({T})|{P}; {A}; {L}; {T}; {E}|{P}; {I}; {A}|{P}, {A}, {W}|{P}\n{A}\n{W}\n{T} / {E}\n({I})
-- \n{P}\n{A}\n{W}\n{T}|{I}\n{P}|{L}; {T}; {E}|{P} / {T}|{P} <{E}>|{I} / {P}|{W}\n{T} / {E}|{L} {N}\n{T} / {E}
"""
FRAMES = [f.replace("\\n", "\n") for f in re.split(r"[|\n]", FRAMES.strip())]
SLOT = {"P": "person", "E": "email", "T": "phone", "I": "id_number", "A": "address"}


class Makers:
    """Makers of items; every choice comes from one seeded source."""

    def __init__(self, seed: int, words: list[str] = (), titles: list[str] = ()):
        self.r = np.random.default_rng(seed)
        self.words, self.titles = words, titles  # lower-case and capitalised words, frequent ones first
        self.next: dict[str, list[str]] = {}
        for names in (*GIVEN.values(), *SURNAMES.values()):
            for n in names:
                s = "^^" + n.lower() + "$"
                for i in range(len(s) - 2):
                    self.next.setdefault(s[i : i + 2], []).append(s[i + 2])

    def one(self, options):
        return options[int(self.r.integers(len(options)))]

    def odds(self, p: float) -> bool:
        return bool(self.r.random() < p)

    def digits(self, n: int, first: str = "0123456789") -> str:
        return self.one(first) + "".join(self.one("0123456789") for _ in range(n - 1)) if n else ""

    def common(self, of: list[str]) -> str:
        """A word of a list in order of frequency, frequent ones more often."""
        return of[int(len(of) * self.r.random() ** 2)]

    def named(self) -> str:
        """A word that a street or place is named with: any word, or an invented one."""
        if self.words and self.odds(0.4):
            return self.common(self.titles) if self.odds(0.5) else self.common(self.words).capitalize()
        return self.word()

    def word(self) -> str:
        """An invented name."""
        if self.titles and self.odds(0.08):
            return self.titles[int(self.r.integers(len(self.titles) // 8, len(self.titles)))]
        if self.odds(0.4):
            out = "".join(self.one("b c d f g h k l m n p r s t v z br dr gr kr pl st tr fl sk".split()) + self.one("a e i o u a e i o u á é ö y".split()) + self.one(["", "", "", "n", "r", "s", "l", "m"]) for _ in range(int(self.r.integers(1, 4))))
            return (out + self.one(["", "", "son", "er", "ard", "ett", "berg", "ski", "elli", "ado", "ing", "wick", "dorf", "ier", "ova"])).capitalize()
        while True:
            out, at = "", "^^"
            while len(out) < 14:
                c = self.one(self.next[at])
                if c == "$":
                    break
                out, at = out + c, at[1] + c
            if 3 <= len(out) < 14 and out.strip("'-") == out:
                return "-".join(x.capitalize() for x in out.split("-"))

    def language(self) -> str:
        return self.one(["en", "fr", "de", "es", "it", "en", "fr", "de", "es", "it", "xx"])

    def given(self, g: str) -> str:
        return self.one(GIVEN[g]) if self.odds(0.6) else self.word()

    def surname(self, g: str) -> str:
        s = self.one(SURNAMES[g]).replace("-", " " if self.odds(0.5) else "-") if self.odds(0.35) else self.word()
        return self.one(PARTICLES[g]) + s if self.odds(0.06) else s

    def person(self) -> str:
        g = self.language()
        first, last = self.given(g), self.surname(g)
        k = self.r.random()
        double = last + "-" + self.word() if self.odds(0.12) else last
        letter = first[0] + "."
        if k < 0.46:
            return f"{first} {double}"
        if k < 0.54:
            return f"{first} {self.one('ABCDEFGHJKLMNPRSTVW')}. {last}"
        if k < 0.67:
            return f"{letter} {double}"
        if k < 0.70:
            return f"{letter}{self.one(['', ' '])}{self.one('ABCDEFGHJKLMNPRSTVW')}. {last}"
        if k < 0.79:
            return f"{double.upper()} {first}"
        if k < 0.82:
            return f"{first} {double.upper()}"
        if k < 0.90:
            return f"{double}, {first}"
        if k < 0.92:
            return f"{last}, {letter}"
        if k < 0.95:
            return f"{first} {self.given(g)} {last}"
        if k < 0.98:
            return f"{first} {last} {self.surname(g)}"
        return f"{first} {last}".upper()

    def email(self) -> str:
        g = self.language()
        plain = lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if c.isalnum() and ord(c) < 128).lower()
        f, s = plain(self.given(g)) or "info", plain(self.surname(g)) or "post"
        user = self.one([f"{f}.{s}", f"{f[0]}.{s}", f"{f[0]}{s}", f"{f}_{s}", f"{s}-{f}", f"{s}.{f}", f"{f}{self.digits(2)}", f"{s}{self.digits(2)}", s, f"{f}+{self.one(['web', 'maps', 'list', 'carte', 'x1'])}", "info", "contact", f"{f}{s}"])
        w = plain(self.word()) or "haus"
        tld = self.one("org com net example test invalid fr de it es eu co.uk".split())
        domain = self.one(DOMAINS) if self.odds(0.3) else self.one([f"{w}.{tld}", f"mail.{w}.{tld}", f"{w}.example", f"mairie-{w}.{tld}", f"{w}-{plain(self.word()) or 'a'}.{tld}"])
        k = self.r.random()
        if k < 0.6:
            out = f"{user}@{domain}"
        else:
            at = self.one([" @ ", "(at)", " (at) ", " [at] ", "[at]", " AT ", " at ", "(AT)", " {at} ", "＠", "{at}", " (arroba) ", " (chiocciola) "])
            dot = self.one([".", ".", " dot ", " [dot] ", " (dot) ", "(dot)", "[dot]", " DOT ", " (punto) ", " [punkt] ", " (point) "])
            if at in (" @ ", "＠"):
                dot = "."
            out = user + at + domain.replace(".", dot)
        return out.upper() if self.odds(0.08) else out

    def phone(self) -> str:
        r, d = self.one, self.digits
        gap = r([" ", " ", " ", ".", "-", "\xa0", ""])
        pairs = lambda n: gap.join(d(2) for _ in range(n))
        k = self.r.random()
        if k < 0.16:
            return "0" + d(1, "123456789") + gap + pairs(4)
        if k < 0.26:
            return r(["+33", "0033"]) + r([" ", " ", ""]) + r(["", "(0)"]) + d(1, "123456789") + gap + pairs(4)
        if k < 0.36:
            return r(["+49", "0049", "+43", "+41"]) + r([" ", " (0)", "", "-"]) + d(int(self.r.integers(2, 5)), "123456789") + r([" ", "-", "/", ""]) + d(int(self.r.integers(4, 7))) + r(["", "", f"-{d(2)}", f"-{d(3)}", f" {d(3)}"])
        if k < 0.47:
            a = "0" + d(int(self.r.integers(2, 5)), "123456789")
            return r([a + " ", f"({a}) ", a + "/", a + "-", a + " / "]).replace(" / ", "/") + r([d(6), d(7), f"{d(4)} {d(3)}", f"{d(3)} {d(2)} {d(2)}", f"{d(5)}-{d(2)}", f"{d(5)}-{d(3)}"])
        if k < 0.62:
            a, b, c = d(3, "23456789"), d(3, "23456789"), d(4)
            return r(["", "", "+1 ", "+1-", "1-"]) + r([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"])
        if k < 0.76:
            return r([f"07{d(3)} {d(6)}", f"07{d(3)} {d(3)} {d(3)}", f"01{d(3)} {d(6)}", f"020 {d(4)} {d(4)}", f"(01{d(2)}) {d(3)} {d(4)}", f"+44 (0){d(2)} {d(4)} {d(4)}", f"+44 {d(4)} {d(3)} {d(3)}", f"0044 {d(4)} {d(6)}"])
        if k < 0.88:
            n = [int(self.r.integers(2, 4)) for _ in range(int(self.r.integers(3, 5)))]
            return r(["+", "00"]) + d(2, "23456789") + r([" ", "-", " "]) + r([" ", "-", "."]).join(d(x, "123456789") for x in n)
        return r([f"9{d(2)} {d(3)} {d(3)}", f"6{d(2)} {d(2)} {d(2)} {d(2)}", f"+34 9{d(2)} {d(3)} {d(3)}", f"+39 0{d(2)} {d(4)} {d(3)}", f"0{d(2)} {d(7)}", f"+39 3{d(2)} {d(3)} {d(4)}", f"+46 {d(2)} {d(3)} {d(2)} {d(2)}", f"0{d(2)}-{d(3)} {d(2)} {d(2)}"])

    def id_number(self) -> str:
        r, d = self.one, self.digits
        cap = lambda n, of="ABCDEFGHIJKLMNPQRSTVWXYZ": "".join(r(of) for _ in range(n))
        k = self.r.random()
        s = r([" ", " ", "", "-"])
        if k < 0.19:
            out = r(["QQ", cap(2)]) + r([f"{s}{d(2)} {d(2)} {d(2)}{s}", f"{s}{d(6)}{s}", f" {d(2)} {d(2)} {d(2)} "]) + r("ABCD")
        elif k < 0.39:
            g = r([" ", " ", "", "."])
            e = r([g, g, "-", " "])
            out = g.join([r("12"), d(2), r(["01", "05", "12", "17", d(2)]), d(2), d(3), d(3)]) + e + d(2)
        elif k < 0.53:
            out = r([d(8), f"{d(2)}.{d(3)}.{d(3)}", r("XYZ") + s + d(7)]) + r(["", "-", " ", ""]) + cap(1)
        elif k < 0.66:
            parts = [cap(3), cap(3), d(2) + r("ABCDEHLMPRST") + d(2), cap(1) + d(3) + cap(1)]
            out = r(["", "", " "]).join(parts)
        elif k < 0.76:
            out = r(["L", "T", "Z", cap(1)]) + "".join(r("0123456789CFGHJKLMNPRTVWXYZ") for _ in range(7)) + d(1) if self.odds(0.35) else r(["ZZ", "ZZZ", cap(2)]) + "".join(r("0123456789CFGHJKLMNPRTVWXYZ") for _ in range(6)) + r(["", " "]) + d(2)
        elif k < 0.82:
            out = r([d(11, "123456789"), f"{d(2, '123456789')} {d(3)} {d(3)} {d(3)}"])
        elif k < 0.88:
            out = f"{d(3)}-{d(2)}-{d(4)}"
        elif k < 0.92:
            out = r([" ", "-"]).join(d(4, "123456789") for _ in range(4))
        else:
            out = r([f"756.{d(4)}.{d(4)}.{d(2)}", f"{d(2)}.{d(2)}.{d(2)}-{d(3)}.{d(2)}", f"{d(6)}-{d(4)}", f"{d(2)} {d(6)} {cap(1)} {d(3)}", f"{cap(3)}{d(6)}", f"{cap(2)}{d(7)}"])
        return out.lower() if self.odds(0.12) else out

    def street(self, g: str, numbered: bool) -> str:
        r = self.one
        name = self.named() if self.odds(0.4) else None
        number = self.digits(int(self.r.integers(1, 4)), "123456789")
        suffix = r(["", "", "", r("abcABCD"), " " + r("abcAB")])
        if g == "en":
            full = (name or (r(STREET_NAMES[g]) + (" " + r(STREET_NAMES[g]) if self.odds(0.25) else ""))) + " " + r(STREET_TYPES[g])
            return number + suffix.strip() + r([" ", " ", " ", ", "]) + full if numbered else full
        if g == "fr":
            own = name or r(STREET_NAMES[g])
            link = r(["", "", "d'", "de l'"]) if own[0] in "AEIOUÉÈÎÔaeioué" else r(["", "de la ", "du ", "des ", "de "])
            full = r(STREET_TYPES[g]) + " " + link + own
            return number + r(["", "", "", " bis", " ter", " quater", suffix]) + r([" ", " ", ", "]) + full if numbered else full
        if g == "de":
            if self.odds(0.25):
                full = r(DE_LEADS) + " " + r(DE_PLACES)
            elif self.odds(0.2):
                full = r(["Alte ", "Neue ", "Obere ", "Kleine ", "Lange "]) + r(STREET_TYPES[g][:7]).capitalize()
            elif self.odds(0.2):
                full = (name or r(GIVEN[g])) + "-" + self.word() + "-" + r(["Straße", "Weg", "Platz", "Str.", "Allee"])
            else:
                full = (name or r(STREET_NAMES[g])) + r(STREET_TYPES[g])
            return full + " " + number + suffix if numbered else full
        link = r(["", "", "de la ", "del ", "de los ", "de "] if g == "es" else ["", "", "", "del ", "della ", "dei ", "di "])
        full = r(STREET_TYPES[g]) + " " + link + (name or r(STREET_NAMES[g]))
        full = full.replace("C/ ", r(["C/ ", "C/"]))
        if not numbered:
            return full
        return full + r([" ", " ", ", ", ", ", ", nº ", " n.º ", ", núm. "] if g == "es" else [" ", " ", ", ", ", ", ", n. ", " n. "]) + number + suffix

    def address(self) -> str:
        g = self.one(["en", "fr", "de", "es", "it"])
        if self.odds(0.04):
            return self.one([f"{self.word()}straat {self.digits(2, '123456789')}", f"ul. {self.word()} {self.digits(2, '123456789')}", f"{self.word()}gatan {self.digits(2, '123456789')}", f"{self.word()}gracht {self.digits(3, '123456789')}"])
        return self.street(g, True)

    def place(self) -> str:
        if self.odds(0.4):
            return self.one(PLACES).replace("-", self.one([" ", "-"]))
        return self.one(["", "", "", "Bad ", "Saint-", "Villa ", "Le ", "La ", "San ", "Mont ", "New ", "Groß ", "Sint ", "Nowa ", "Lake ", "Upper ", "Santa "]) + self.word() + self.one(["", "", "", "ville", "burg", "ton", " am Forst", " di Sotto", "-sur-Lande", " Green"])

    def filler(self, slot: str) -> str:
        r, d = self.one, self.digits
        if slot in SLOT:
            return getattr(self, SLOT[slot])()
        if slot == "S":
            return self.street(r(["en", "fr", "de", "es", "it"]), False)
        if slot == "L":
            return self.place()
        if slot == "W":
            return f"{d(5)} {self.place()}"
        if slot == "N":
            return r([d(1), d(2, "123456789"), f"19{d(2)}", f"20{d(2)}", d(4, "123456789"), f"{d(1)}.{d(1)}", f"{d(1)},{d(1)}"])
        if slot == "H":
            return "@" + self.word().lower() + r(["", "_map", d(2)])
        if slot == "C":
            return r([f"{d(2, '123456')}.{d(4)}, {d(1, '123456789')}.{d(4)}", f"{d(2, '123456')}°{d(2)}' N, {d(1)}°{d(2)}' E", f"{d(2, '123456')}.{d(6)} / -{d(1, '123456789')}.{d(6)}"])
        return r([f"{r('ABCDEFGHKLMNPRST')}{r('ABCDEFGHKLMNPRST')}-{d(5)}", f"{d(4)}/{d(2)}", f"GEO-{d(4)}-{d(3)}", f"{r('ABCDEFGHKLMNPRST')}{d(3)}", f"{d(9, '123456789')}", f"#{d(5)}", f"v{d(1)}.{d(2)}.{d(1)}", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(8)}-{d(4)}", f"{d(2)}-{d(4)}-{d(2)}", f"{d(2)}.{d(2)}.20{d(2)}", f"20{d(2)}-{d(2)}-{d(2)}"])

    def scattered(self) -> tuple[str, list[tuple[int, int, str]]]:
        """Items and look-alikes among random words."""
        out, spans = "", []
        items = int(self.r.integers(0, 4))
        for k in range(items + 1):
            if self.odds(0.25):  # few or no words
                n = int(self.r.integers(0, 2))
            else:
                n = int(self.r.integers(1, 9))
            for _ in range(n):
                w = self.common(self.words)
                if self.odds(0.1):
                    w = self.filler(self.one("NNNNLSRC"))
                elif not out or out[-2:] in (". ", "? ") or out[-1] == "\n" or self.odds(0.02):
                    w = w.capitalize()
                elif self.odds(0.06):
                    w += " " + self.common(self.titles)
                    w += " " + self.common(self.words)
                out += w + (" " if self.odds(0.82) else self.one([", ", ", ", ". ", ". ", ": ", "; ", " (", ") ", "\n", "? ", " - "]))
            if k < items:
                slot = self.one("PPPAAAETI")
                new = self.filler(slot)
                if out[-1:].isalnum():
                    out += " "
                spans.append((len(out), len(out) + len(new), SLOT[slot]))
                out += new + self.one([" ", " ", " ", " ", ", ", ". ", "; ", ") ", "\n", ": ", " / ", "? "])
        return out, spans

    def framed(self) -> tuple[str, list[tuple[int, int, str]]]:
        """One frame, filled, and the spans of its items."""
        out, spans, frame, i = "", [], self.one(FRAMES), 0
        while i < len(frame):
            if frame[i] == "{" and frame[i + 2 : i + 3] == "}":
                new = self.filler(frame[i + 1])
                if frame[i + 1] in SLOT:
                    spans.append((len(out), len(out) + len(new), SLOT[frame[i + 1]]))
                out += new
                i += 3
            else:
                out += frame[i]
                i += 1
        return out, spans
